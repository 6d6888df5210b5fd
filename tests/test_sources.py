"""Sources and sinks: column/table discovery, JDBC (in-process Derby), CSV,
stage files, and the staged run."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from scrutin.sources import catalog as K
from scrutin.sources import columns as R
from scrutin.sources import files
from scrutin.sources import jdbc
from scrutin.sources import stages
from scrutin.sources import testdata as TD


def test_pick_table():
    assert R.pick_table(["a", "resultatslegi", "votes"]) == "resultatslegi"
    assert R.pick_table(["x", "mes_votes", "election_2022"]) == "election_2022"  # patterns in order
    assert R.pick_table(["x", "y"]) == "x"
    with pytest.raises(ValueError):
        R.pick_table([])


def test_resolve_mapping_exact_before_substring():
    m = R.resolve_mapping(["nuance", "votants", "annee", "Tour", "dept"])
    assert m["annee"] == "annee" and m["tour"] == "Tour" and m["departement"] == "dept"
    # decision Q25: 'an' would match 'nuance' as a substring; the exact name wins
    m2 = R.resolve_mapping(["nuance", "voters", "year"])
    assert m2["annee"] == "year" and m2["votants"] == "voters" and m2["exprimes"] is None


def test_resolve_columns_defaults(spark):
    df = spark.createDataFrame([(2017, 1, 31, "RN", 5)], "year INT, round INT, dept INT, party STRING, votes LONG")
    r = R.resolve_columns(df).first().asDict()
    assert r == {"annee": 2017, "tour": 1, "departement": 31, "nuance": "RN", "voix": 5,
                 "inscrits": 0, "votants": 0, "abstentions": 0, "exprimes": 0}


def test_jdbc_derby_pushdown(spark):
    url = "jdbc:derby:memory:scrutin_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = [(i, 2017 + (i % 2) * 5, 1 + i % 2, [9, 31, 75][i % 3], "RN", 10 * i) for i in range(30)]
    src = spark.createDataFrame(rows, "ID BIGINT, ANNEE INT, TOUR INT, DEPARTEMENT INT, NUANCE STRING, VOIX BIGINT")
    src.write.jdbc(url, "RESULTATSLEGI", mode="overwrite", properties=props)
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    df = jdbc.read_jdbc(spark, url, "RESULTATSLEGI", props, years=[2022], rounds=[2],
                        partition_column="ID", lower_bound=0, upper_bound=30, num_partitions=3)
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    pushed = leaf.metadata().get("PushedFilters").get().replace(" ", "")
    assert "TOUR" in pushed and "ANNEE" in pushed and "DEPARTEMENT" in pushed, pushed
    got = sorted(r.voix for r in df.collect())
    want = sorted(v for (_, y, t, d, _, v) in rows if y == 2022 and t == 2 and d in (9, 31))
    assert got == want and df.rdd.getNumPartitions() == 3
    assert "RESULTATSLEGI" in jdbc.list_tables(spark, url, props)
    hist = jdbc.read_jdbc(spark, url, "RESULTATSLEGI", props, min_year=2020)
    leaf = hist._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert "GreaterThanOrEqual(ANNEE,2020)" in leaf.metadata().get("PushedFilters").get().replace(" ", "")
    assert hist.count() == sum(1 for r in rows if r[1] >= 2020 and r[3] in (9, 31))


def test_csv_round_trip_and_datasets(spark):
    out = tempfile.mkdtemp(prefix="scrutin-csv-")
    b = TD.ballots(spark, "/root/testdata/sf0.001").limit(50)
    files.write_table(b, os.path.join(out, "legislative_2017.csv"), fmt="csv")
    back = files.read_csv(spark, os.path.join(out, "legislative_2017.csv"))
    assert back.count() == 50 and "annee" in back.columns
    files.write_table(b, os.path.join(out, "socio_2022.parquet"))
    ds = files.collect_datasets(spark, out, years=[2017, 2022], types=["legislative", "socio_economic"], fmt="parquet")
    assert list(ds) == ["socio_economic_2022"]
    st = files.stacked_datasets({"legislative_2017": back.select("annee"), "socio_2022": b.select("voix")})
    assert set(st.columns) == {"annee", "voix", "election_type", "annee_source"} and st.count() == 100


def test_partitioned_write_prunes(spark):
    out = tempfile.mkdtemp(prefix="scrutin-part-")
    b = TD.ballots(spark, "/root/testdata/sf0.001")
    files.write_table(b, out, partition_by=["annee"])
    df = spark.read.parquet(out).where(F.col("annee") == 2015)
    assert "PartitionFilters: [isnotnull(annee" in df._jdf.queryExecution().executedPlan().toString()


def test_profile_and_elections(spark):
    b = TD.ballots(spark, "/root/testdata/sf0.001")
    p = K.table_profile(b).first()
    assert p.total_records == b.count() and p.total_columns == len(b.columns)
    el = [(r.annee, r.tour) for r in K.list_elections(b).collect()]
    assert el == sorted(el, key=lambda x: (-x[0], x[1]))


def test_staged_run(spark):
    from scrutin.plans import run as L2
    out = tempfile.mkdtemp(prefix="scrutin-run-")
    raw = TD.ballots_raw(spark, "/root/testdata/sf0.001")
    done = L2.run(spark, raw, out, stages=("collect", "process", "analyze", "charts"), tiebreak=TD.TIEBREAK)
    assert set(done) == {"collect", "process", "analyze", "charts"}
    assert spark.read.parquet(done["process"]).count() > 0
    assert spark.read.parquet(f"{done['charts']}/map_points").count() == 13


BALLOT = "annee INT, tour INT, departement INT, nuance STRING, voix LONG, inscrits LONG, votants LONG, abstentions LONG, exprimes LONG"


def ballots_of(spark, year, label="RN", n=6):
    return spark.createDataFrame([(year, 1 + i % 2, [31, 34, 9][i % 3], label, 10 + i, 100, 60, 40, 50) for i in range(n)], BALLOT)


def years_in(df):
    return {r[0]: r[1] for r in df.groupBy("annee").count().collect()}


def test_writing_one_year_again_keeps_the_others(spark):
    out = tempfile.mkdtemp(prefix="scrutin-years-")
    files.write_table(ballots_of(spark, 2017).union(ballots_of(spark, 2022)), out, partition_by=["annee"])
    files.write_table(ballots_of(spark, 2022, n=2), out, partition_by=["annee"])
    assert years_in(spark.read.parquet(out)) == {2017: 6, 2022: 2}
    files.write_table(ballots_of(spark, 2022, n=2), out, partition_by=["annee"], whole=True)
    assert years_in(spark.read.parquet(out)) == {2022: 2}


def test_stage_manifest_refuses_what_is_not_whole(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="scrutin-stage-"), "t")
    with pytest.raises(stages.StageError):
        stages.read_stage(spark, out)
    m = stages.write_stage(ballots_of(spark, 2017).union(ballots_of(spark, 2022)), out, partition_by=["annee"])
    assert m.rows == 12 and stages.manifest(spark, out) == m and stages.read_stage(spark, out).count() == 12
    assert stages.read_stage(spark, out).schema["annee"].dataType.simpleString() == "int"
    with pytest.raises(stages.StageError, match="another input"):
        stages.read_stage(spark, out, made_from="x")
    # only rows of one year are written again; the manifest covers the whole table
    newer = stages.write_stage(ballots_of(spark, 2022, n=1), out, partition_by=["annee"], update=True)
    assert newer.rows == 7 and newer.identity != m.identity
    with pytest.raises(stages.StageError, match="other columns"):
        stages.write_stage(ballots_of(spark, 2022).drop("voix"), out, partition_by=["annee"], update=True)
    # a file too many, or too few
    ballots_of(spark, 2012).write.mode("append").partitionBy("annee").parquet(out)
    with pytest.raises(stages.StageError, match="not those of its manifest"):
        stages.read_stage(spark, out)
    # a writer that was lost: files without a manifest
    lost = os.path.join(tempfile.mkdtemp(prefix="scrutin-lost-"), "t")
    ballots_of(spark, 2017).write.parquet(lost)
    with pytest.raises(stages.StageError, match="no manifest"):
        stages.read_stage(spark, lost)


def test_a_failed_write_leaves_no_manifest(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="scrutin-fail-"), "t")
    stages.write_stage(ballots_of(spark, 2017), out)
    broken = ballots_of(spark, 2022).withColumn("voix", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception):
        stages.write_stage(broken, out)
    assert stages.manifest(spark, out) is None


def test_run_uses_the_given_rows(spark):
    from scrutin.plans import run as L2
    out = tempfile.mkdtemp(prefix="scrutin-given-")
    L2.run(spark, ballots_of(spark, 2022), out, stages=("collect", "process"))
    done = L2.run(spark, ballots_of(spark, 2017), out, stages=("process", "analyze"))
    assert years_in(stages.read_stage(spark, done["process"])) == {2017: 6}
    done = L2.run(spark, None, out, stages=("process",))
    assert years_in(stages.read_stage(spark, done["process"])) == {2022: 6}


def test_run_updates_one_year(spark):
    from scrutin.plans import run as L2
    out = tempfile.mkdtemp(prefix="scrutin-update-")
    L2.run(spark, ballots_of(spark, 2017).union(ballots_of(spark, 2022)), out, stages=("collect", "process"))
    done = L2.run(spark, ballots_of(spark, 2022, "LR", 3), out, stages=("collect", "process", "analyze"), update=True)
    got = stages.read_stage(spark, done["process"])
    assert years_in(got) == {2017: 6, 2022: 3} and {r.nuance for r in got.where("annee = 2022").collect()} == {"LR"}
    # a year whose new rows are all invalid loses its old ones
    done = L2.run(spark, ballots_of(spark, 2022, "LR", 3).withColumn("voix", F.lit(-1).cast("long")), out, stages=("collect", "process"), update=True)
    assert years_in(stages.read_stage(spark, done["process"])) == {2017: 6}
    # analysing a processed table that is older than the raw table is an error
    L2.run(spark, ballots_of(spark, 2012), out, stages=("collect",))
    with pytest.raises(stages.StageError, match="another input"):
        L2.run(spark, None, out, stages=("analyze",))
    with pytest.raises(ValueError):
        L2.run(spark, None, out, stages=("collect",))


def test_open_data_headings_and_region(spark):
    out = tempfile.mkdtemp(prefix="scrutin-open-")
    lines = ["\ufeffCode du département;Libellé du département;Année;Tour;Nuance;Voix;% Voix/Ins;Exprimés",
             "09;Ariège;2022;1;RN;10;1,5;50", "9;Ariège;2022;2;RN;11;1,5;50", "2A;Corse;2022;1;LR;7;1;9", "75;Paris;2022;1;LR;7;1;9", "31;Haute-Garonne;2022;1;;5;1;9"]
    with open(os.path.join(out, "presidentielle_2022.csv"), "w", encoding="utf-8") as f:
        f.write("\n".join(lines))
    with open(os.path.join(out, "insee_data_2022.csv"), "w", encoding="utf-8") as f:
        f.write("DEP;COM;LIBCOM;taux_pauvrete\n31;31001;Agassac;12.5\n75;75056;Paris;10\n")
    ds = files.collect_datasets(spark, out, fmt="csv")
    assert list(ds) == ["presidentielle_2022", "socio_economic_2022"]
    votes = ds["presidentielle_2022"]
    assert votes.columns == ["departement", "Libellé du département", "annee", "tour", "nuance", "voix", "% Voix/Ins", "exprimes"]
    assert sorted(r.departement for r in votes.collect()) == ["09", "31", "9"]
    assert ds["socio_economic_2022"].columns[:3] == ["departement", "commune", "nom_commune"] and ds["socio_economic_2022"].count() == 1
    assert files.read_open_data(spark, os.path.join(out, "presidentielle_2022.csv"), regions=None).count() == 5
    # two headings of one name: the first takes it
    assert files.canonical_headings(["Code département", "DEP", "annee", "Année"]) == ["departement", "DEP", "annee", "Année"]
    with pytest.raises(FileNotFoundError):
        files.collect_datasets(spark, out, years=[1999], fmt="csv")


def test_jdbc_text_codes_and_slices(spark):
    url, props = "jdbc:derby:memory:scrutin_text;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = [(i, 2022, 1, ["09", "9", "31", "75", "2A"][i % 5], "RN", i) for i in range(100)]
    src = spark.createDataFrame(rows, "ID BIGINT, ANNEE INT, TOUR INT, DEPARTEMENT STRING, NUANCE STRING, VOIX BIGINT")
    src.write.option("createTableColumnTypes", "DEPARTEMENT VARCHAR(4), NUANCE VARCHAR(8)").jdbc(url, "VOTES", mode="overwrite", properties=props)
    want = sorted(r[5] for r in rows if r[3] in ("09", "9", "31"))
    df = jdbc.read_jdbc(spark, url, "VOTES", props, partition_column="ID", num_partitions=4)
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert "In(DEPARTEMENT" in leaf.metadata().get("PushedFilters").get().replace(" ", "")
    assert sorted(r.voix for r in df.collect()) == want and df.rdd.getNumPartitions() == 4
    # every slice has rows: the bounds are those of the table
    assert min(len(p) for p in jdbc.read_jdbc(spark, url, "VOTES", props, regions=None, partition_column="ID", num_partitions=4).rdd.glom().collect()) == 25
    by = jdbc.read_jdbc(spark, url, "VOTES", props, predicates=["ID < 50", "ID >= 50"])
    assert by.rdd.getNumPartitions() == 2 and sorted(r.voix for r in by.collect()) == want
    for wrong in ({"num_partitions": 4}, {"partition_column": "ID"}, {"partition_column": "ID", "num_partitions": 2, "predicates": ["ID < 5"]}):
        with pytest.raises(ValueError):
            jdbc.read_jdbc(spark, url, "VOTES", props, **wrong)
    assert jdbc.list_tables(spark, url, props) == ["VOTES"] and jdbc.list_tables(spark, url, props, schema_pattern="NONE%") == []


def test_history_info_reads_the_metadata(spark):
    from scrutin.operators import predict as P
    history = ballots_of(spark, 2017)
    meta = spark.createDataFrame([("Forest", 0.9, "2002-2017")], "best_model_name STRING, best_score DOUBLE, years_covered STRING")
    assert tuple(P.history_info(history, meta).first()) == ("Forest", 0.9, 6, "2002-2017", 13)
    assert P.history_info(history, meta.drop("years_covered", "best_score")).first()[1:4] == (0.0, 6, P.history_info(history).first().years_covered)
    empty = spark.createDataFrame([("", None, None)], "best_model_name STRING, best_score DOUBLE, years_covered STRING")
    assert P.history_info(history, empty).first() == P.history_info(history).first()


def rounded(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_adding_a_year_to_the_summary_equals_a_full_run(spark):
    from scrutin.operators import aggregates as A
    from scrutin.plans import run as L2
    from scrutin.plans import summaries as SM
    b = TD.ballots(spark, "/root/testdata/sf0.001").where("annee between 2012 and 2015")
    step, whole = (tempfile.mkdtemp(prefix="scrutin-sum-") for _ in range(2))
    todo = ("collect", "process", "summarise", "analyze")
    L2.run(spark, b.where("annee < 2015"), step, todo, tiebreak=TD.TIEBREAK)
    before = {n for n, _ in stages._data_files(spark, f"{step}/summary")}
    done = L2.run(spark, b.where("annee = 2015"), step, todo, tiebreak=TD.TIEBREAK, update=True)
    after = {n for n, _ in stages._data_files(spark, done["summarise"])}
    assert before < after and all(n.startswith("annee=2015/") for n in after - before)   # no other year was written
    full = L2.run(spark, b, whole, todo, tiebreak=TD.TIEBREAK)
    assert rounded(spark.read.parquet(done["analyze"])) == rounded(spark.read.parquet(full["analyze"]))
    summary, rows = SM.read(spark, done["summarise"]), stages.read_stage(spark, full["process"])
    for merged, direct in ((SM.by_department(summary), A.by_department(rows)), (SM.by_year(summary), A.by_year(rows)),
                           (A.historical_trends(summary), A.historical_trends(rows)), (A.regional_trends(summary), A.regional_trends(rows))):
        assert merged.columns == direct.columns and rounded(merged) == rounded(direct)


def test_update_processes_all_years_if_the_raw_table_moved_on(spark):
    from scrutin.plans import run as L2
    out = tempfile.mkdtemp(prefix="scrutin-moved-")
    L2.run(spark, ballots_of(spark, 2017).union(ballots_of(spark, 2022)), out, ("collect", "process"))
    L2.run(spark, ballots_of(spark, 2017, n=2), out, ("collect",), update=True)      # not processed
    done = L2.run(spark, ballots_of(spark, 2022, n=3), out, ("collect", "process"), update=True)
    assert years_in(stages.read_stage(spark, done["process"])) == {2017: 2, 2022: 3}
