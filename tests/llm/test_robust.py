"""Texts and rows that are hard on an operator: long runs, hot keys, clashing names."""

import time

import pytest
from pyspark.sql import functions as F

from docrel.llm import exact_dedup, mixing, secret_scan, simhash, surrogates

UNITS = ["a.", "1.", "a-", "x@a.", "eyJ", "eyJ.", ".eyJaaaaaaaa", "token ", "token=", "-----BEGIN PRIVATE KEY-----",
         "-----BEGIN ", "AKIA", "0a", "Mr ", "Mr Aa ", "Aa-", "A. ", "van ", "Mr van ", "+1 ", "12.", "555-", "Dr. A "]


def test_long_domains_do_not_end_the_executor(spark):
    rows = [("mail x@a" + ".1" * 200_000,), ("mail x@a" + ".1" * 100_000 + ".com",), ("x@" + "ab." * 1000 + "com.12",)]
    df = spark.createDataFrame(rows, "text string")
    got = [r.m for r in df.select(F.regexp_extract_all("text", F.lit(surrogates.EMAIL), F.lit(0)).alias("m")).collect()]
    assert got[0] == [] and got[1] == [rows[1][0][5:]] and got[2] == [rows[2][0][:-3]]
    mail = "Ask a.b@c.d-e.org, x@y.z or q@r.co.1x.9. p@s.t2 u@v..com"
    one = spark.createDataFrame([(mail,)], "text string")
    found = one.select(F.regexp_extract_all("text", F.lit(surrogates.EMAIL), F.lit(0)).alias("m")).first().m
    assert found == ["a.b@c.d-e.org", "q@r.co", "p@s.t2"]


@pytest.mark.parametrize("rule", ["MENTION", "HINT"])
def test_patterns_hold_on_a_megabyte_of_one_unit(spark, rule):
    rows = [(u * (1_000_000 // len(u)),) for u in UNITS]
    df = spark.createDataFrame(rows, "text string").repartition(8)
    pattern = F.lit(getattr(surrogates, rule))
    began = time.time()
    assert df.select(F.size(F.regexp_extract_all("text", pattern, F.lit(0))).alias("n")).agg(F.count("n")).first()[0] == len(rows)
    assert time.time() - began < 60


def test_a_long_mention_gets_its_surrogate(spark):
    df = spark.createDataFrame([(1, "to x@" + "ab." * 3000 + "com now")], "doc_id long, text string")
    row = surrogates.scrubbed(df, "k").first()
    assert row.n_mentions == 1 and "ab.ab.ab" not in row.text and len(row.text) == len(df.first().text)


def test_secret_scan_is_linear():
    began = time.process_time()
    for unit in UNITS:
        secret_scan.find(unit * (5_000_000 // len(unit) if unit.startswith("eyJ") else 1_000_000 // len(unit)))
    assert time.process_time() - began < 30
    a, b, c = "eyJ" + "x" * 8, "eyJ" + "y" * 9, "z" * 8
    web = lambda t: [s[1:] for s in secret_scan.find(t) if s[0] == "web_token"]
    assert web(f"k={a}.{b}.{c}!") == [(2, 2 + len(a + b + c) + 2)]
    assert web(f"abc.{a}.{b}.{c}") == [(4, 4 + len(a + b + c) + 2)]
    assert web(f"pre{a}.{b}.{c}.{a}.{b}.{c}")[0] == (3, 3 + len(a + b + c) + 2)
    assert len(web(f"{a}.{b}.{c}.{a}.{b}.{c}")) == 2
    assert web(f"{a}.{b}.short {a}.zzzzzzzz.{c} eyJ.{b}.{c}") == []


def test_web_tokens_as_the_plain_pattern():
    import random
    import re
    plain = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}")
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice(["eyJ", "abcdefgh", ".", " ", "eyJabcdefgh", ".eyJabcdefgh.", "x"]) for _ in range(r.randrange(1, 25)))
        assert list(secret_scan._web_tokens(text)) == [m.span() for m in plain.finditer(text)], text


def test_a_ledger_with_doubled_rows_gives_the_same(spark, tmp_path):
    df = spark.createDataFrame([(i, f"token={'a' * 9}{i % 3}") for i in range(20)], "doc_id long, text string")
    path = str(tmp_path / "ledger")
    once = secret_scan.report(df, ledger=path).collect()
    spark.read.parquet(path).write.mode("append").partitionBy("rules").parquet(path + "2")
    spark.read.parquet(path).write.mode("append").partitionBy("rules").parquet(path + "2")
    assert sorted(secret_scan.report(df, ledger=path + "2").collect()) == sorted(once) and len(once) == 20


@pytest.mark.parametrize("hot_id", [7, None])
def test_a_heavy_digest_of_one_id_is_settled_where_its_rows_are(spark, hot_id):
    df = spark.range(0, 30_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot_id)).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    out = exact_dedup.membership(df).withColumn("task", F.spark_partition_id())
    hot = out.filter("group_size > 1")
    assert hot.agg(F.sum(F.col("kept").cast("int"))).first()[0] == 1
    assert hot.filter(F.col("kept")).first().keep_id == hot_id
    assert hot.count() == 10_000 and hot.groupBy("task").count().agg(F.max("count")).first()[0] < 5000


def test_stages_with_names_of_their_own(odd):
    for name, stage in (("mix_id mix_tie mix_source mix_times mix_text mix_copy", mixing.applied),
                        ("stay_id stay_tie sim_tie sim_rank sim_none fp rep root", simhash.deduplicated),
                        ("dedup_sha dedup_h64 dedup_keep dedup_hot dedup_rank at keep_at", exact_dedup.deduplicated)):
        plain = sorted(map(str, stage(odd).collect()))
        clash = odd
        for c in name.split():
            clash = clash.withColumn(c, F.lit(5))
        out = stage(clash)
        assert out.columns == clash.columns
        assert sorted(map(str, out.select(*odd.columns).collect())) == plain
