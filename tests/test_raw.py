"""Reading raw files: strictness, escapes, preview, listing, landing."""

from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

import pytest

from vigilog.operators import cleaning
from vigilog.plans import jobs
from vigilog.sources import raw
from vigilog.sources.lake import Lake, discard, materialise, read_landed, read_silver, scratch_path, scratch_scope, write_by_day
from vigilog.sources.schemas import AUTH_RAW, AUTH_SILVER, REDTEAM_RAW

AUTH_LINES = [
    "3,C41$@DOM2,U90@DOM2,C41,C7,Kerberos,Network,LogOn,Success",
    "3,U12@DOM2,SYSTEM@C41,C41,TGT,NTLM,Interactive,LogOff,Fail",
    "8,?,U90@DOM2,C7,C41,?,?,LogOn,Success",
]
REDTEAM_LINES = [
    "90210,U12@DOM2,C41,C7",
    "90355,U77@DOM3,C41,C1044",
]


def gz(path, lines):
    with gzip.open(path, "wt", newline="") as out:
        out.write("\n".join(lines) + "\n")
    return str(path)


def test_sample_lines(spark, tmp_path):
    auth = raw.read_auth(spark, gz(tmp_path / "auth.txt.gz", AUTH_LINES))
    assert auth.schema == AUTH_RAW
    assert [",".join(map(str, row)) for row in auth.collect()] == AUTH_LINES
    attacks = raw.read_redteam(spark, gz(tmp_path / "redteam.txt.gz", REDTEAM_LINES))
    assert attacks.schema == REDTEAM_RAW
    assert [",".join(map(str, row)) for row in attacks.collect()] == REDTEAM_LINES
    assert cleaning.to_silver(auth).dtypes == spark.createDataFrame([], AUTH_SILVER).dtypes


@pytest.mark.parametrize(
    "bad",
    [
        "zz,a@D,b@D,C1,C2,NTLM,Batch,LogOn,Success",
        "2,a@D,b@D,C1,C2,NTLM,Batch,LogOn",
        "2,a@D,b@D,C1,C2,NTLM,Batch,LogOn,Success,extra",
    ],
)
def test_landing_refuses_a_malformed_line(spark, tmp_path, bad):
    path = gz(tmp_path / "auth.txt.gz", [*AUTH_LINES, bad])
    attacks = gz(tmp_path / "redteam.txt.gz", REDTEAM_LINES)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        jobs.land(spark, Lake(str(tmp_path / "lake")), path, attacks)


@pytest.mark.parametrize("bad", ["zz,U1@D,C1,C2", "5,U1@D,C1", "5,U1@D,C1,C2,extra"])
def test_landing_refuses_a_malformed_attack(spark, tmp_path, bad):
    path = gz(tmp_path / "auth.txt.gz", AUTH_LINES)
    attacks = gz(tmp_path / "redteam.txt.gz", [*REDTEAM_LINES, bad])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        jobs.land(spark, Lake(str(tmp_path / "lake")), path, attacks)


def test_malformed_lines_are_put_aside(spark, tmp_path):
    bad = [
        "zz,a@D,b@D,C1,C2,NTLM,Batch,LogOn,Success",
        "2,a@D,b@D,C1,C2,NTLM,Batch,LogOn",
        "2,a@D,b@D,C1,C2,NTLM,Batch,LogOn,Success,extra",
        "nothing",
    ]
    path = gz(tmp_path / "auth.txt.gz", [*AUTH_LINES, *bad, "9,,b@D,C1,C2,NTLM,Batch,LogOn,"])
    attacks = gz(tmp_path / "redteam.txt.gz", REDTEAM_LINES)
    lake = Lake(str(tmp_path / "lake"))
    jobs.land(spark, lake, path, attacks, keep_rejects=True)
    landed = read_landed(spark, lake.landed())
    assert landed.schema == AUTH_RAW
    assert sorted(",".join("" if v is None else str(v) for v in row) for row in landed.collect()) == sorted([*AUTH_LINES, "9,,b@D,C1,C2,NTLM,Batch,LogOn,"])
    rejects = {r[raw.CORRUPT]: (r.raison, r.objet) for r in spark.read.parquet(lake.rejects()).collect()}
    assert rejects.keys() == set(bad) and landed.count() + len(rejects) == len(AUTH_LINES) + len(bad) + 1
    assert rejects[bad[0]][0] == "type d'un champ" and {rejects[b][0] for b in bad[1:]} == {"nombre de champs"}
    assert {o for _, o in rejects.values()} == {raw.manifest(spark, path).first().objet}
    jobs.silver(spark, lake)
    assert read_silver(spark, lake.silver()).count() == 4
    # An update adds to the rejects; without the option it stops, and nothing is landed.
    more = gz(tmp_path / "more.txt.gz", ["90000,a@D,b@D,C1,C2,NTLM,Batch,LogOn,Success", "broken"])
    jobs.gold_tables(spark, lake)
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        jobs.update(spark, lake, more)
    assert read_landed(spark, lake.landed()).count() == 4
    jobs.update(spark, lake, more, keep_rejects=True)
    assert read_landed(spark, lake.landed()).count() == 5 and spark.read.parquet(lake.rejects()).count() == 5


def test_a_log_without_malformed_lines_has_no_rejects(spark, tmp_path):
    path, attacks = gz(tmp_path / "auth.txt.gz", AUTH_LINES), gz(tmp_path / "redteam.txt.gz", REDTEAM_LINES)
    lake = Lake(str(tmp_path / "lake"))
    jobs.land(spark, lake, path, attacks, keep_rejects=True)
    assert read_landed(spark, lake.landed()).count() == 3 and spark.read.parquet(lake.rejects()).count() == 0


def test_lineage_of_landed_lines(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    for name, lines in (("a.gz", AUTH_LINES[:2]), ("b c+d%20.gz", AUTH_LINES[2:]), ("none.gz", [])):
        gz(logs / name, lines)
    lake = Lake(str(tmp_path / "lake"))
    jobs.land(spark, lake, str(logs), gz(tmp_path / "redteam.txt.gz", REDTEAM_LINES))
    known = {r.path.rsplit("/", 1)[1]: tuple(r)[4:] for r in spark.read.parquet(lake.manifest()).collect()}
    assert known == {"a.gz": (2, 3, 3), "b c+d%20.gz": (1, 8, 8), "none.gz": (0, None, None)}
    assert raw.not_landed(raw.manifest(spark, str(logs)), spark.read.parquet(lake.manifest())).isEmpty()


def test_empty_field_and_backslash(spark, tmp_path):
    path = gz(tmp_path / "auth.txt.gz", [r'5,a\"b,b@D,C1,?,NTLM,,LogOn,'])
    row = raw.read_auth(spark, path).first()
    assert row.source_user_domain == r"a\"b"
    assert row.logon_type is None and row.success_failure is None
    cleaned = cleaning.to_silver(raw.read_auth(spark, path)).first()
    assert cleaned.destination_computer is None and cleaned.succes is None
    assert cleaned.categorie_destination == "autre"


def test_preview_and_manifest(spark, tmp_path):
    path = gz(tmp_path / "auth.txt.gz", AUTH_LINES)
    assert [r.value for r in raw.preview(spark, path, 2).collect()] == AUTH_LINES[:2]
    listed = raw.manifest(spark, str(tmp_path)).collect()
    assert [r.path.rsplit("/", 1)[1] for r in listed] == ["auth.txt.gz"]
    assert listed[0].length == (tmp_path / "auth.txt.gz").stat().st_size


def test_preview_reads_the_first_file_by_name(spark, tmp_path):
    for compress in (False, True):
        folder = tmp_path / f"logs{compress}"
        folder.mkdir()
        for name, count in (("b", 5000), ("a", 20)):
            lines = [f"{name}{i}" for i in range(count)]
            (folder / "0").write_text("")
            if compress:
                gz(folder / f"{name}.csv.gz", lines)
            else:
                (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")
        assert [r.value for r in raw.preview(spark, str(folder)).collect()] == [f"a{i}" for i in range(10)]
    assert raw.preview(spark, str(tmp_path / "logsFalse" / "0")).count() == 0


def test_a_hot_day_of_one_gzip_file_is_cut(spark, tmp_path):
    lines = [f"{5 if i % 10 else i * 20},{hashlib.sha256(b'%d' % i).hexdigest()}@D,b@D,C1,C{i % 97},NTLM,Batch,LogOn,Success" for i in range(100_000)]
    source = raw.read_auth(spark, gz(tmp_path / "auth.txt.gz", lines))
    assert source.rdd.getNumPartitions() == 1
    path = str(tmp_path / "days")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_by_day(source, path, file_rows=2_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = spark.read.parquet(path + "/jour_part=0")
    sizes = [r["count"] for r in hot.groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == hot.count() > 90_000
    assert max(sizes) <= 2_000 and len(sizes) <= 1.3 * sum(sizes) / 2_000
    assert read_landed(spark, path).exceptAll(source).count() == 0 and read_landed(spark, path).count() == 100_000
    # The pieces are written by many tasks: a task's files share the number in their names.
    tasks = {p.name.split("-")[1] for p in (tmp_path / "days" / "jour_part=0").glob("part-*.parquet")}
    assert len(tasks) > 3


def test_scratch_folders(spark, tmp_path):
    own = scratch_path(spark, "x", str(tmp_path))
    assert own.startswith(f"{tmp_path}/vigilog-{spark.sparkContext.applicationId}/x-")
    named = scratch_path(spark, "x")
    assert named.startswith(f"{spark.conf.get('spark.checkpoint.dir')}/vigilog-{spark.sparkContext.applicationId}/x-")


def test_landing_splits_one_gzip_file(spark, tmp_path):
    lines = [f"{second},a@D,b@D,C1,C2,NTLM,Batch,LogOn,Success" for second in range(0, 864000, 100)]
    path = gz(tmp_path / "auth.txt.gz", lines)
    source = raw.read_auth(spark, path)
    assert source.rdd.getNumPartitions() == 1
    attacks = gz(tmp_path / "redteam.txt.gz", REDTEAM_LINES)
    lake = Lake(str(tmp_path / "lake"))
    jobs.land(spark, lake, path, attacks)
    assert spark.read.parquet(lake.attacks()).schema == REDTEAM_RAW
    landed = read_landed(spark, lake.landed())
    assert landed.schema == AUTH_RAW
    assert landed.exceptAll(source).count() == 0 and landed.count() == len(lines)
    dated = read_landed(spark, lake.landed(), with_day=True)
    assert {r.jour_part for r in dated.select("jour_part").distinct().collect()} == set(range(10))
    assert dated.where("temps_secondes div 86400 <> jour_part").count() == 0
    jobs.silver(spark, lake)
    assert read_silver(spark, lake.silver()).count() == len(lines)


def test_scratch_tables_go_with_their_scope(spark, tmp_path):
    outside = scratch_path(spark, "stays", str(tmp_path))
    with scratch_scope(spark):
        inner = materialise(spark.range(5), scratch_path(spark, "goes", str(tmp_path)))
        with scratch_scope(spark):
            deepest = scratch_path(spark, "first", str(tmp_path))
            materialise(spark.range(2), deepest)
        assert not Path(deepest).exists() and inner.count() == 5
        kept = materialise(inner.where("id > 1"), outside)
    assert kept.count() == 3 and len(list(Path(outside).parent.iterdir())) == 1
    assert discard(spark, [outside, outside + "-none"]) == [outside]
