import random

from pyspark.sql import functions as F

from crewlens.llm import quality
from crewlens.llm.common import table
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string"


def words_of(rng, n, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def cases():
    rng = random.Random(5)
    odd = [
        None, "", " \t\n\x0b\x0c\r", "one", "a b c a b c", "a a a a a", "x\ny\nx\n x\n\n \nx", "é ü z  q",
        "#*$%&|<> " * 20, "line of words here\n" * 40, words_of(rng, 60) + " ###" * 30, "b\x1fc d\x85e " * 30,
        words_of(rng, 40, 3), "ab " * 30000, words_of(rng, 5000, 40), "supercalifragilisticexpialidocious " * 60,
    ]
    rows = [(i, t, f"h{i % 3}") for i, t in enumerate(odd)]
    rows += [(100 + i, words_of(rng, 80), f"h{i % 3}") for i in range(60)]
    rows += [(200 + i, words_of(rng, 80 if i < 6 else 10), "bad") for i in range(60)]
    rows += [(300 + i, words_of(rng, 80 if i % 2 else 10), None) for i in range(6)] + [(None, words_of(rng, 90), "h1")]
    return [*rows, rows[20], rows[20]]


def compare(rows, df):
    got = quality.verdicts(df, "doc_id").collect()
    want = []
    for (d, t, _), kept in zip(rows, brute.quality([(s, t) for _, t, s in rows]), strict=True):
        m = brute.measures(t)
        want.append((d, *m[:5], m[0] < 50 or 100 * m[4] > 50 * m[0], kept))
    key = lambda r: tuple((x is not None, x) for x in r)
    have = [(r.doc_id, *(r[m] for m in quality.MEASURES), r.base_failed, r.kept) for r in got]
    assert sorted(have, key=key) == sorted(want, key=key)


def test_fixture_equals_brute_force(make):
    rows = cases()
    compare(rows, make(SCHEMA, rows).repartition(4))


def test_whole_table_equals_brute_force(spark):
    df = table(spark, SMALL, "documents").select("doc_id", "text", "source")
    compare([tuple(r) for r in df.collect()], df)


def test_a_rejected_host_takes_its_good_documents_along(make):
    df = make(SCHEMA, cases())
    kept = {r.doc_id for r in quality.keep_good(df).collect()}
    assert not kept & set(range(200, 260)) and set(range(100, 160)) <= kept


def judged(spark, hosts, per_host, chance, rule="symbols"):
    """Documents of equal hosts that fail a rule by chance, or as ``chance`` (SQL) says."""
    return spark.range(hosts * per_host).selectExpr(
        f"concat('h', id div {per_host}) source", f"if({chance}, array('{rule}'), cast(array() as array<string>)) failed_rules"
    )


def test_many_small_hosts_that_are_alike_lose_no_good_document(spark):
    for per_host in (2, 3, 5):
        found = quality.hosts(judged(spark, 20_000, per_host, "pmod(xxhash64(id), 10) < 3"))
        assert found.where("rejected").count() == 0
    rate = found.selectExpr("explode(rules) r").where("r.rule = 'symbols'").selectExpr("min(r.rate) a", "max(r.rate) b").first()
    assert 0.2 < rate.a and rate.b < 0.45


def test_hosts_that_differ_are_told_apart_and_each_rule_has_its_own_rate(spark):
    bad = judged(spark, 2000, 5, "id div 5 % 4 = 0 OR pmod(xxhash64(id), 50) = 0")
    found = quality.hosts(bad)
    assert found.where("rejected").count() == 500
    assert found.where("rejected AND int(substr(host, 2)) % 4 <> 0").count() == 0
    half = judged(spark, 400, 10, "id % 10 < 4").unionByName(judged(spark, 400, 10, "id % 10 < 4", "word_length"))
    # Each rule fails a fifth of the host's documents; taken together they would be two fifths.
    rules = quality.hosts(half).selectExpr("explode(rules) r").selectExpr("r.rule", "r.rate").distinct().collect()
    assert {r.rule: round(r.rate, 9) for r in rules} == {"base": 0.0, "symbols": 0.2, "dup_lines": 0.0, "word_length": 0.2}


def test_hosts_of_one_document_and_a_single_host(spark):
    assert quality.hosts(judged(spark, 300, 1, "id % 3 < 2")).where("rejected").count() == 300
    assert quality.hosts(judged(spark, 1, 300, "id % 3 < 1")).where("rejected").count() == 0


def test_kept_rows_keep_their_columns(make):
    rows = cases()
    df = make(SCHEMA, rows).withColumn("n_words", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("key", F.lit(2)).withColumn("host", F.lit(0))
    got = quality.keep_good(df)
    assert got.columns == df.columns
    flags = brute.quality([(s, t) for _, t, s in rows])
    assert got.count() == sum(flags)


def test_empty(make):
    assert quality.verdicts(make(SCHEMA, []), "doc_id").collect() == []
    assert quality.keep_good(make(SCHEMA, [])).collect() == []
