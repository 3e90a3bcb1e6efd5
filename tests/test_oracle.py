"""Every registered query against an independent engine, over the whole tables."""

from __future__ import annotations

import pytest
from compare import assert_same

from __spark_entry__ import entry, oracle_sql, queries
from vigilog.plans.catalog import all_queries
from vigilog.plans.oracle import checks

# Column(s) each query is ordered by: "-" for descending.
ORDERS = {
    **{f"diag_freq_{c}": ("-nb", c) for c in ("authentication_type", "logon_type", "authentication_orientation", "success_failure")},
    **{f"diag_malformed_{s}_user": ("-nb", f"{s}_user_domain") for s in ("source", "destination")},
    **{f"diag_malformed_{s}_computer": ("-nb", f"{s}_computer") for s in ("source", "destination")},
    "silver_category_distribution": ("-nb", "categorie_destination"),
    "top_machines": ("-nb_evenements", "destination_computer", "categorie_destination"),
    "evolution_temporelle": ("jour",),
    "top_utilisateurs": ("-taux_echec_pct", "source_user_domain"),
    "activite_par_heure": ("heure",),
    "relation_utilisateur_machine": ("source_user_domain", "destination_computer"),
    "anomalies_horaires_classees": ("-nb_connexions_horaire_inhabituel", "source_user_domain", "destination_computer", "heure_du_jour"),
    "diversite_machines": ("-nb_machines_distinctes", "source_user_domain"),
}


def test_every_query_has_a_check():
    assert set(all_queries()) == set(checks())
    assert set(all_queries()) <= set(queries()) and set(checks()) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(checks()))
def test_equals_sql(spark, sf_dir, name):
    assert_same(all_queries()[name](spark, sf_dir), sf_dir, checks()[name])


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_order(spark, sf_dir, name):
    def key(row):
        parts = []
        for column in ORDERS[name]:
            value = row[column.lstrip("-")]
            known = value if isinstance(value, (int, float)) else (value or "").encode()
            parts.append((value is not None, -known if column[0] == "-" else known))
        return parts

    rows = all_queries()[name](spark, sf_dir).collect()
    assert rows and rows == sorted(rows, key=key)


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 1
    assert df.columns[0] == "total_evenements"
