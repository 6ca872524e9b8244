"""The jobs: growing input, interrupted batches, reruns, partitions, command lines, configs."""

import json
import logging

import duckdb
import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from jobs import common, curation_feed, release_review
from jobs import queries as job_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("documents", "labels"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(df):
    cols = sorted(df.columns)
    return sorted(json.dumps([None if v is None else v for v in r], default=str) for r in (df.select(cols).collect()))


def wanted(duck, name):
    cur = duck.execute(job_queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    order = [names.index(c) for c in sorted(names)]
    return sorted(json.dumps([r[i] for i in order], default=str) for r in cur.fetchall())


def files(path):
    return {(str(p.relative_to(path)), p.stat().st_mtime_ns) for p in path.rglob("*.parquet")}


@pytest.mark.parametrize("name", sorted(job_queries.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    assert rows(job_queries.QUERIES[name](spark, SF)) == wanted(duck, name)


def test_feed_takes_only_what_is_new(spark, duck, tmp_path):
    """Three arrivals, a run after each, then one without any: the same as all at once, and each file is read once."""
    feed, out, cp = tmp_path / "feed", tmp_path / "out", str(tmp_path / "cp")
    docs, seen = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id"), []
    for low, high in ((0, 90), (90, 91), (91, 10_000)):
        docs.where(F.col("doc_id").between(low, high - 1)).coalesce(1).write.mode("append").parquet(str(feed))
        got = curation_feed.run(spark, str(feed), str(out), cp)
        seen.append(got.count())
        assert got.select("input_id").distinct().count() == seen[-1]
    assert seen == [90, 91, 200]
    assert rows(got) == wanted(duck, "job1_curation_feed")
    before = files(out)
    assert rows(curation_feed.run(spark, str(feed), str(out), cp)) == wanted(duck, "job1_curation_feed") and files(out) == before
    batches = {r["batch"]: r["n"] for r in common.read(spark, f"{out}/records", curation_feed.RECORDS).groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert sorted(batches.values()) == [1, 90, 109]


def test_feed_in_small_batches(spark, tmp_path):
    """One file a batch: as many records and identities; what is a repetition doesn't depend on the batches, only what came first."""
    spark.read.parquet(f"{SF}/documents.parquet").repartition(7).write.parquet(str(tmp_path / "feed"))
    small = curation_feed.run(spark, str(tmp_path / "feed"), str(tmp_path / "a"), str(tmp_path / "cpa"), curation_feed.Config(files_per_batch=1))
    whole = curation_feed.run(spark, str(tmp_path / "feed"), str(tmp_path / "b"), str(tmp_path / "cpb"), curation_feed.Config(status_folders=False))
    count = lambda df: sorted(map(tuple, df.groupBy("identity", "status").agg(F.count("*"), F.count_if(F.coalesce(F.col("collision_type") != "BLOCK1_COLLISION", F.lit(False)))).collect()), key=str)
    assert count(small) == count(whole)
    assert common.read(spark, str(tmp_path / "a/firsts"), curation_feed.FIRSTS).select("identity").distinct().count() == common.read(spark, str(tmp_path / "a/firsts"), curation_feed.FIRSTS).count()


@pytest.mark.parametrize("fails_at", ["records", "conflicts", "firsts"])
def test_feed_repeats_an_interrupted_batch(spark, duck, tmp_path, monkeypatch, fails_at):
    feed, out, cp = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "cp")
    docs, write = spark.read.parquet(f"{SF}/documents.parquet"), common.write
    docs.where("doc_id < 100").coalesce(1).write.parquet(str(feed))
    curation_feed.run(spark, str(feed), out, cp)
    docs.where("doc_id >= 100").coalesce(1).write.mode("append").parquet(str(feed))

    def stops(df, path, *by, log):
        n = write(df, path, *by, log=log)
        if f"/{fails_at}/" in path:
            raise OSError("the machine is gone")
        return n

    with monkeypatch.context() as m:
        m.setattr(curation_feed, "write", stops)
        with pytest.raises(Exception, match="the machine is gone"):
            curation_feed.run(spark, str(feed), out, cp)
    assert rows(curation_feed.run(spark, str(feed), out, cp)) == wanted(duck, "job1_curation_feed")


def test_feed_of_odd_rows(spark, tmp_path):
    shape = "doc_id long, text string, lang string, source string, n_chars long, status string"
    long = "Some words that stand in a text which is long enough. "
    given = [(1, None, None, None, None, "x"), (None, long, "en", "a", 1, "x"), (3, long, "en", "b", 1, "x"), (3, long, "en", "b", 1, "x"), (4, "", "en", "a", 0, "x"), (5, long * 5000, "en", "a", 1, "x")]
    spark.createDataFrame(given, shape).coalesce(1).write.parquet(str(tmp_path / "feed"))
    got = curation_feed.run(spark, str(tmp_path / "feed"), str(tmp_path / "out"), str(tmp_path / "cp")).collect()
    assert len(got) == 6 and sorted(r["rejection_code"] for r in got if r["rejection_code"]) == ["ERR_EMPTY", "ERR_EMPTY", "ERR_MW_LIMIT"]
    assert [r["collision_type"] for r in got if r["input_id"] == "3"] == ["ANNOTATION_CONFLICT"] * 2
    spark.createDataFrame([], shape).write.parquet(str(tmp_path / "none"))
    assert curation_feed.run(spark, str(tmp_path / "none"), str(tmp_path / "o"), str(tmp_path / "c")).count() == 0


def test_release_is_partitioned_and_rerun_by_language(spark, duck, tmp_path):
    out = tmp_path / "out"
    docs, labels = str(tmp_path / "docs.parquet"), f"{SF}/labels.parquet"
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(docs)
    first = rows(release_review.run(spark, docs, labels, str(out)))
    assert first == wanted(duck, "job2_release_review")
    languages = {p.name for p in (out / "release").glob("language=*")}
    assert languages == {p.name for p in (out / "review").glob("language=*")} and len(languages) > 1
    # One language anew: only its partitions change, and its rows are the same.
    before = files(out)
    assert rows(release_review.run(spark, docs, labels, str(out), release_review.Config(languages=["de"]))) == first
    changed = {p for p, _ in files(out) ^ before}
    assert changed and all("/language=de/" in f"/{p}" for p in changed)
    # A stricter policy, for one language only.
    strict = release_review.Config(languages=["de"], policy=release_review.curate.Criteria(max_chars=41))
    got = release_review.run(spark, docs, labels, str(out), strict)
    assert got.where("language = 'de' and outcome = 'released'").count() == 0 < got.where("outcome = 'released'").count()


def test_release_of_odd_rows(spark, tmp_path):
    long = "Some words that stand in a text which is long enough. "
    given = [(1, None, None, None), (2, long, "", "a"), (3, long, "en", "b"), (None, long + "x", None, "b"), (4, "", "en", "a"), (5, long + "y", "en", "a")]
    spark.createDataFrame(given, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "d"))
    spark.createDataFrame([(3, 1, 0), (3, 0, 0), (5, 1, 0), (4, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "l"))
    got = {r["input_id"]: r for r in release_review.run(spark, str(tmp_path / "d"), str(tmp_path / "l"), str(tmp_path / "out")).collect()}
    assert {k: (r["language"], r["outcome"], r["duplicate_of"], r["comparison"]) for k, r in got.items()} == {
        "1": ("none", "rejected", None, "unlabelled"), "2": ("none", "released", None, "unlabelled"), "3": ("en", "duplicate", "2", "unresolved"),
        None: ("none", "released", None, "unlabelled"), "4": ("en", "rejected", None, "tp"), "5": ("en", "released", None, "tn"),
    }


def test_jobs_leave_the_session_as_it_was(spark, tmp_path):
    before = dict(spark.conf.getAll)
    tables = {t.name for t in spark.catalog.listTables()}
    release_review.run(spark, f"{SF}/documents.parquet", f"{SF}/labels.parquet", str(tmp_path / "out"))
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(str(tmp_path / "feed"))
    curation_feed.run(spark, str(tmp_path / "feed"), str(tmp_path / "o"), str(tmp_path / "c"))
    assert dict(spark.conf.getAll) == before and {t.name for t in spark.catalog.listTables()} == tables and not spark.streams.active


def test_configs(tmp_path):
    for job in (curation_feed, release_review):
        assert common.load(job.__file__.replace(".py", ".toml"), job.Config) == job.Config()
    for text in ("files_per_bach = 3", "files_per_batch = 'many'", "[policy]\nmax_char = 3"):
        (tmp_path / "c.toml").write_text(text)
        with pytest.raises(ValueError):
            common.load(tmp_path / "c.toml", curation_feed.Config)


def test_command_lines(spark, tmp_path, monkeypatch, caplog):
    """The command lines start a session and stop it; here they are given the tests' own, which must stay."""
    monkeypatch.setattr(SparkSession, "stop", lambda _: stopped.append(1))
    stopped = []
    spark.read.parquet(f"{SF}/documents.parquet").write.parquet(str(tmp_path / "feed"))
    with caplog.at_level(logging.INFO):
        assert curation_feed.main(["--documents", str(tmp_path / "feed"), "--out", str(tmp_path / "o"), "--checkpoint", str(tmp_path / "c")]) == 0
        assert release_review.main(["--documents", str(tmp_path / "feed"), "--labels", f"{SF}/labels.parquet", "--out", str(tmp_path / "r")]) == 0
        assert release_review.main(["--documents", str(tmp_path / "missing"), "--labels", f"{SF}/labels.parquet", "--out", str(tmp_path / "r")]) == 2
    assert len(stopped) == 3 and "took 200 rows in 1 batches" in caplog.text and "wrote 200 rows" in caplog.text
