"""The same datasets as plain SQL for an independent engine, used only to check results.

Each dataset is a named relation over others; a check is the chain of relations it needs
as CTEs. The branches and names in here are fixed by the log format and the tables.
"""

from __future__ import annotations

from vigilog.plans import fixture
from vigilog.sources.schemas import AUTH_RAW, AUTH_SILVER, REDTEAM_RAW

_RAW = ", ".join(AUTH_RAW.names)
_LOG = ",\n".join(f"{text} AS {name}" for name, text in fixture.LOG_COLUMNS.items())
_FAILED = "count(*) FILTER (WHERE succes IS NOT TRUE)"
_NIGHT = "(heure_du_jour NOT BETWEEN 6 AND 22)"


def _freq(relation: str, column: str, where: str = "TRUE", tail: str = "") -> str:
    return f"SELECT {column}, count(*) AS nb FROM {relation} WHERE {where} GROUP BY {column} {tail}"


def _top(column: str, where: str) -> str:
    return _freq("auth_brut", column, where, f"ORDER BY nb DESC, {column} LIMIT 20")


def _share(part: str, whole: str) -> str:
    return f"round(100.0::DOUBLE * ({part}) / ({whole}), 2)"


# name -> (relations it reads, SELECT)
_RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "base": (
        (),
        f"SELECT event_id, CAST({fixture.DUCKDB_SECONDS} + 1 AS BIGINT) AS temps_secondes, {_LOG} FROM events",
    ),
    "auth_brut": (
        ("base",),
        f"SELECT {_RAW} FROM base UNION ALL SELECT {_RAW} FROM base WHERE {fixture.WRITTEN_TWICE}",
    ),
    "redteam": (
        ("base",),
        f"""SELECT temps_secondes + ({fixture.ATTACK_DELAY}) AS temps_secondes,
              source_user_domain AS user_domain, source_computer, destination_computer
            FROM base WHERE ({fixture.IS_ATTACK}) AND source_user_domain <> '?'""",
    ),
    "silver": (
        ("auth_brut",),
        """SELECT temps_secondes,
             (temps_secondes % 86400) / 3600.0::DOUBLE AS heure_du_jour,
             nullif(source_user_domain, '?') AS source_user_domain,
             nullif(destination_user_domain, '?') AS destination_user_domain,
             nullif(source_computer, '?') AS source_computer,
             nullif(destination_computer, '?') AS destination_computer,
             CASE WHEN destination_computer = 'TGT' THEN 'ticket_kerberos'
                  WHEN left(destination_computer, 1) = 'U' THEN 'identifiant_utilisateur'
                  WHEN left(destination_computer, 1) = 'C' THEN 'machine'
                  ELSE 'autre' END AS categorie_destination,
             CASE WHEN authentication_type LIKE 'MICROSOFT_AUTHENTICATION_PACKAGE%'
                  THEN 'MICROSOFT_AUTHENTICATION_PACKAGE_V1_0'
                  ELSE nullif(authentication_type, '?') END AS authentication_type,
             nullif(logon_type, '?') AS logon_type,
             nullif(authentication_orientation, '?') AS authentication_orientation,
             success_failure = 'Success' AS succes
           FROM auth_brut""",
    ),
    "par_heure": (
        ("silver",),
        f"""SELECT source_user_domain, CAST(heure_du_jour AS INTEGER) AS heure,
              count(*) AS nb_connexions, {_FAILED} AS nb_echecs
            FROM silver WHERE source_user_domain IS NOT NULL GROUP BY ALL""",
    ),
    "par_machine": (
        ("silver",),
        """SELECT destination_computer, categorie_destination, count(*) AS nb_evenements,
             count(DISTINCT source_user_domain) AS nb_utilisateurs_distincts
           FROM silver WHERE destination_computer IS NOT NULL GROUP BY ALL""",
    ),
    "nuit": (
        ("silver",),
        f"""SELECT source_user_domain, destination_computer, heure_du_jour,
              count(*) AS nb_connexions_horaire_inhabituel
            FROM silver WHERE {_NIGHT} AND source_user_domain IS NOT NULL GROUP BY ALL""",
    ),
    "echecs": (
        ("silver",),
        f"""SELECT *, {_share("nb_echecs", "total_tentatives")} AS taux_echec_pct
            FROM (SELECT source_user_domain, count(*) AS total_tentatives, {_FAILED} AS nb_echecs
                  FROM silver WHERE source_user_domain IS NOT NULL GROUP BY ALL)
            WHERE total_tentatives >= 10""",
    ),
    "diversite": (
        ("silver",),
        """SELECT source_user_domain, count(DISTINCT destination_computer) AS nb_machines_distinctes,
             count(*) AS nb_connexions_totales
           FROM silver WHERE categorie_destination = 'machine' AND source_user_domain IS NOT NULL GROUP BY ALL""",
    ),
    "par_jour": (
        ("silver",),
        f"""SELECT CAST(temps_secondes / 86400 AS INTEGER) AS jour,
              count(*) AS nb_connexions, {_FAILED} AS nb_echecs
            FROM silver GROUP BY ALL""",
    ),
    "uniques": (
        ("silver",),
        """SELECT source_user_domain, destination_computer, count(*) AS nb_occurrences
           FROM silver WHERE categorie_destination = 'machine' AND source_user_domain IS NOT NULL
           GROUP BY ALL HAVING nb_occurrences = 1""",
    ),
    "loose": (
        ("redteam", "nuit"),
        """SELECT r.temps_secondes, r.user_domain, r.destination_computer,
             n.source_user_domain IS NOT NULL AS detecte_par_anomalie_horaire
           FROM redteam r LEFT JOIN nuit n
             ON n.source_user_domain = r.user_domain AND n.destination_computer = r.destination_computer""",
    ),
    "strict": (
        ("redteam", "silver"),
        f"""SELECT temps_secondes, user_domain, s.destination_computer, heure_du_jour,
              coalesce({_NIGHT}, FALSE) AS detecte_par_anomalie_horaire
            FROM redteam r JOIN silver s USING (temps_secondes)
            WHERE s.source_user_domain = r.user_domain AND s.destination_computer = r.destination_computer""",
    ),
    "seuils": (
        ("echecs", "diversite"),
        """SELECT round((SELECT quantile_cont(taux_echec_pct, 0.95) FROM echecs), 6) AS seuil_echec,
             round((SELECT quantile_cont(nb_machines_distinctes, 0.95) FROM diversite), 6) AS seuil_machines""",
    ),
    "drapeaux": (
        ("strict", "echecs", "diversite", "uniques", "seuils"),
        f"""SELECT v.temps_secondes, v.user_domain, v.destination_computer, v.heure_du_jour,
              e.taux_echec_pct, d.nb_machines_distinctes, u.nb_occurrences AS occurrences_paire,
              {_NIGHT} AS flag_horaire,
              e.taux_echec_pct > (SELECT seuil_echec FROM seuils) AS flag_echec,
              d.nb_machines_distinctes > (SELECT seuil_machines FROM seuils) AS flag_machines,
              u.nb_occurrences = 1 AS flag_paire_rare
            FROM strict v
            LEFT JOIN echecs e ON e.source_user_domain = v.user_domain
            LEFT JOIN diversite d ON d.source_user_domain = v.user_domain
            LEFT JOIN uniques u ON u.source_user_domain = v.user_domain
              AND u.destination_computer = v.destination_computer""",
    ),
    "bilan": (
        ("drapeaux",),
        """SELECT count(*) AS total_evenements,
             count(*) FILTER (WHERE flag_horaire) AS detectes_horaire,
             count(*) FILTER (WHERE flag_echec) AS detectes_echec,
             count(*) FILTER (WHERE flag_machines) AS detectes_machines,
             count(*) FILTER (WHERE flag_paire_rare) AS detectes_paire_rare,
             count(*) FILTER (WHERE flag_horaire OR flag_echec OR flag_machines OR flag_paire_rare)
               AS detectes_au_moins_un
           FROM drapeaux""",
    ),
    "comparaison": (
        ("bilan",),
        "SELECT *, "
        + ", ".join(
            f"{_share(f'detectes_{name}', 'total_evenements')} AS pct_{name}"
            for name in ("horaire", "echec", "machines", "paire_rare", "au_moins_un")
        )
        + " FROM bilan",
    ),
}


def _check(select: str, *reads: str, given: tuple[str, ...] = ()) -> str:
    needed: list[str] = []

    def add(name: str) -> None:
        if name in given or name in needed:
            return
        for other in _RELATIONS[name][0]:
            add(other)
        needed.append(name)

    for name in reads:
        add(name)
    chain = ",\n".join(f"{name} AS ({_RELATIONS[name][1]})" for name in needed)
    return f"WITH {chain}\n{select}" if chain else select


def _whole(relation: str, given: tuple[str, ...] = ()) -> str:
    return _check(f"SELECT * FROM {relation}", relation, given=given)


def _rate(relation: str, found: str, given: tuple[str, ...] = ()) -> str:
    detected = "count(*) FILTER (WHERE detecte_par_anomalie_horaire)"
    return _check(
        f"""SELECT count(*) AS total_evenements_redteam, {detected} AS {found},
              {_share(detected, "count(*)")} AS taux_detection_pct FROM {relation}""",
        relation,
        given=given,
    )


_GOLD = {
    "connexions_par_utilisateur_heure": "par_heure",
    "activite_par_machine": "par_machine",
    "anomalies_horaires": "nuit",
    "taux_echec_par_utilisateur": "echecs",
    "machines_distinctes_par_utilisateur": "diversite",
    "volume_par_jour": "par_jour",
    "paires_rares_utilisateur_machine": "uniques",
}


def checks_on_given_log() -> dict[str, str]:
    """Checks on registered tables ``auth_brut`` and ``redteam`` instead of the derived ones."""
    given = ("auth_brut", "redteam")
    relations = {
        **_GOLD,
        "silver_auth": "silver",
        "validation_redteam_loose": "loose",
        "validation_redteam": "strict",
        "seuils_detection": "seuils",
        "detection_flags": "drapeaux",
        "comparaison_criteres_detection": "comparaison",
    }
    found = {name: _whole(relation, given) for name, relation in relations.items()}
    found["taux_detection_loose"] = _rate("loose", "nb_detectes", given)
    found["taux_detection_rigoureux"] = _rate("strict", "nb_a_horaire_inhabituel", given)
    return found


def checks() -> dict[str, str]:
    found = {name: _whole("auth_brut") for name in ("bronze_auth", "bronze_landed")}
    found["bronze_redteam"] = _check(f"SELECT {', '.join(REDTEAM_RAW.names)} FROM redteam", "redteam")
    for column in ("authentication_type", "logon_type", "authentication_orientation", "success_failure"):
        found[f"diag_freq_{column}"] = _check(_freq("auth_brut", column), "auth_brut")
    for side in ("source", "destination"):
        account, computer = f"{side}_user_domain", f"{side}_computer"
        found[f"diag_malformed_{side}_user"] = _check(_top(account, f"NOT contains({account}, '@')"), "auth_brut")
        found[f"diag_malformed_{side}_computer"] = _check(
            _top(computer, rf"NOT regexp_full_match({computer}, 'C[0-9]+\$?')"), "auth_brut"
        )
    found["diag_time_bounds"] = _check(
        """SELECT min(temps_secondes) AS min_temps, max(temps_secondes) AS max_temps,
             count(*) FILTER (WHERE temps_secondes < 0) AS nb_negatifs, count(*) AS nb_total_lignes
           FROM auth_brut""",
        "auth_brut",
    )
    # Names of the report.
    missing = {
        "nb_manquants_source_user": "source_user_domain",
        "nb_manquants_dest_user": "destination_user_domain",
        "nb_manquants_source_computer": "source_computer",
        "nb_manquants_dest_computer": "destination_computer",
        "nb_manquants_auth_type": "authentication_type",
        "nb_manquants_logon_type": "logon_type",
        "nb_manquants_orientation": "authentication_orientation",
    }
    counted = ", ".join(f"count(*) FILTER (WHERE {c} = '?') AS {name}" for name, c in missing.items())
    found["diag_missing_counts"] = _check(f"SELECT {counted}, count(*) AS nb_total_lignes FROM auth_brut", "auth_brut")
    found["silver_auth"] = found["silver_written"] = _whole("silver")
    found["silver_auth_distinct"] = _check("SELECT DISTINCT * FROM silver", "silver")
    found["silver_row_count"] = _check("SELECT count(*) AS nb_lignes FROM silver", "silver")
    found["silver_category_distribution"] = _check(_freq("silver", "categorie_destination"), "silver")
    found["silver_residual_missing"] = _check(
        """SELECT count(*) AS nb_points_interrogation_restants FROM silver
           WHERE '?' IN (authentication_type, logon_type)""",
        "silver",
    )
    found.update({name: _whole(relation) for name, relation in _GOLD.items()})
    found["validation_redteam_loose"] = _whole("loose")
    found["validation_redteam"] = _whole("strict")
    found["taux_detection_loose"] = _rate("loose", "nb_detectes")
    found["taux_detection_rigoureux"] = _rate("strict", "nb_a_horaire_inhabituel")
    found["seuils_detection"] = _whole("seuils")
    found["detection_flags"] = _whole("drapeaux")
    found["comparaison_criteres_detection"] = _whole("comparaison")
    tables = {**_GOLD, "validation_redteam": "loose"}
    found["gold_row_counts"] = _check(
        " UNION ALL ".join(f"SELECT '{n}' AS nom, count(*) AS nb_lignes FROM {r}" for n, r in tables.items()),
        *tables.values(),
    )
    found["top_machines"] = _check(
        "SELECT * FROM par_machine ORDER BY nb_evenements DESC, destination_computer, categorie_destination LIMIT 20",
        "par_machine",
    )
    found["evolution_temporelle"] = _check("SELECT * FROM par_jour ORDER BY jour", "par_jour")
    found["top_utilisateurs"] = _check(
        "SELECT * FROM echecs ORDER BY taux_echec_pct DESC, source_user_domain LIMIT 20", "echecs"
    )
    found["activite_par_heure"] = _check(
        """SELECT heure, CAST(sum(nb_connexions) AS BIGINT) AS nb_connexions,
             CAST(sum(nb_echecs) AS BIGINT) AS nb_echecs FROM par_heure GROUP BY heure""",
        "par_heure",
    )
    found["efficacite_criteres"] = _check(
        " UNION ALL ".join(
            f"SELECT '{n}' AS critere, detectes_{n} AS detectes, pct_{n} AS pct FROM comparaison"
            for n in ("horaire", "echec", "machines", "paire_rare", "au_moins_un")
        ),
        "comparaison",
    )
    found["relation_utilisateur_machine"] = _whole("uniques")
    found["anomalies_horaires_classees"] = found["anomalies_horaires"]
    found["diversite_machines"] = found["machines_distinctes_par_utilisateur"]
    found["detection_flags_large_list"] = found["detection_flags"]
    found["validation_redteam_large_list"] = found["validation_redteam"]
    found["validation_redteam_loose_large_list"] = found["validation_redteam_loose"]
    found["comparaison_criteres_large_list"] = found["comparaison_criteres_detection"]
    found["lake_gold_row_counts"] = found["gold_row_counts"]
    found["lake_validation_redteam"] = found["validation_redteam"]
    found["lake_comparaison"] = found["comparaison_criteres_detection"]
    found["validation_redteam_ordered"] = found["validation_redteam"]
    found["silver_auth_distinct_colocated"] = found["silver_auth_distinct"]
    found["user_profiles_colocated"] = _check(
        """SELECT e.*, coalesce(nb_machines_distinctes, 0) AS nb_machines_distinctes, CAST(coalesce(nb_connexions_totales, 0) AS BIGINT) AS nb_connexions_totales,
             coalesce(n, 0) AS nb_paires_rares
           FROM echecs e LEFT JOIN diversite USING (source_user_domain)
           LEFT JOIN (SELECT source_user_domain, count(*) AS n FROM uniques GROUP BY ALL) USING (source_user_domain)""",
        "echecs",
        "diversite",
        "uniques",
    )
    found["bronze_manifest"] = _check(
        """SELECT 'day=' || (temps_secondes // 86400) AS objet, count(*) AS nb_lignes, min(temps_secondes) AS premiere_seconde, max(temps_secondes) AS derniere_seconde
           FROM auth_brut GROUP BY ALL""",
        "auth_brut",
    )
    measures = {f"freq_{c}": (c, "TRUE") for c in ("authentication_type", "logon_type", "authentication_orientation", "success_failure")}
    for side in ("source", "destination"):
        measures[f"malformed_{side}_user_domain"] = (f"{side}_user_domain", f"NOT contains({side}_user_domain, '@')")
        measures[f"malformed_{side}_computer"] = (f"{side}_computer", rf"NOT regexp_full_match({side}_computer, 'C[0-9]+\$?')")
    found["diag_one_pass"] = _check(
        " UNION ALL ".join(
            f"""SELECT '{name}' AS mesure, {column} AS valeur, count(*) AS nb, min(temps_secondes) AS min_temps, max(temps_secondes) AS max_temps,
                  count(*) FILTER (WHERE temps_secondes < 0) AS nb_negatifs FROM auth_brut WHERE {where} GROUP BY {column}"""
            for name, (column, where) in measures.items()
        ),
        "auth_brut",
    )
    # Key and counts of each table in the long form.
    long_form = {
        "connexions_par_utilisateur_heure": ("source_user_domain || '|' || heure", "nb_connexions", "nb_echecs"),
        "activite_par_machine": ("destination_computer || '|' || categorie_destination", "nb_evenements", "nb_utilisateurs_distincts"),
        "anomalies_horaires": (
            "source_user_domain || '|' || coalesce(destination_computer, '') || '|' || CAST(round(heure_du_jour * 3600) AS BIGINT)",
            "nb_connexions_horaire_inhabituel",
            "0",
        ),
        "taux_echec_par_utilisateur": ("source_user_domain", "total_tentatives", "nb_echecs"),
        "machines_distinctes_par_utilisateur": ("source_user_domain", "nb_machines_distinctes", "nb_connexions_totales"),
        "volume_par_jour": ("CAST(jour AS VARCHAR)", "nb_connexions", "nb_echecs"),
        "paires_rares_utilisateur_machine": ("source_user_domain || '|' || destination_computer", "nb_occurrences", "0"),
    }
    found["lake_updated_gold"] = _check(
        " UNION ALL ".join(
            f"SELECT '{name}' AS nom, {key} AS cle, CAST({first} AS BIGINT) AS n1, CAST({second} AS BIGINT) AS n2 FROM {_GOLD[name]}"
            for name, (key, first, second) in long_form.items()
        ),
        *_GOLD.values(),
    )
    ordered = ", ".join(f"{c} NULLS FIRST" for c in AUTH_RAW.names)
    line = " || ',' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in AUTH_RAW.names)
    found["bronze_preview"] = _check(f"SELECT {line} AS value FROM auth_brut ORDER BY {ordered} LIMIT 10", "auth_brut")
    cleaned = ", ".join(f"{c} NULLS FIRST" for c in AUTH_SILVER.names)
    found["silver_sample"] = _check(f"SELECT * FROM silver ORDER BY {cleaned} LIMIT 5", "silver")
    return found
