"""Block naming and benchmark decontamination against plain Python."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from civicspark.llm import block_naming, decontaminate
from civicspark.llm.common import keyed
from tests.conftest import SF_SMALL
from tests.llm.frames import PLAIN_WORDS, corpus, documents, low
from tests.oracle_check import assert_matches_oracle


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("block_bytes, hash_bits", [(4096, 64), (7, 64), (16, 3)])
def test_exact_groups(spark, block_bytes, hash_bits):
    rows = corpus()
    groups = defaultdict(list)
    for i, t in rows:
        groups[low(t)].append(i)
    got = block_naming.exact_groups(documents(spark, rows), block_bytes=block_bytes, hash_bits=hash_bits).collect()
    want = {i: (max(groups[low(t)]), len(groups[low(t)]), i == max(groups[low(t)]), _sha(low(t))) for i, t in rows}
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got} == want
    assert len(got) == len(rows)


def test_exact_groups_null_ids_and_repeated_rows(spark):
    rows = [(None, "a"), (None, "a"), (3, "A"), (3, "a"), (5, "b"), (5, "b"), (5, "c"), (None, "d"), (None, None)]
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["n_copies"]) for r in block_naming.exact_groups(documents(spark, rows)).collect())
    assert got == Counter({
        (None, 3, 4, False, 2): 2, (3, 3, 4, True, 2): 2, (5, 5, 2, True, 2): 2, (5, 5, 1, True, 1): 1, (None, None, 1, True, 1): 2,
    })
    kept = block_naming.drop_exact_duplicates(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert sorted((str(r["doc_id"]), low(r["text"])) for r in kept.collect()) == [("3", "a"), ("5", "b"), ("5", "c"), ("None", ""), ("None", "d")]


def test_exact_groups_of_nothing(spark):
    assert block_naming.exact_groups(documents(spark, []).limit(0)).count() == 0
    assert block_naming.drop_exact_duplicates(documents(spark, [])).count() == 0


def _contamination(rows, items, window=13):
    windows = defaultdict(set)
    for i, t in items:
        w = PLAIN_WORDS.findall(low(t))
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[k : k + window])].add(i)
    out = []
    for i, t in rows:
        w, hit, found = PLAIN_WORDS.findall(low(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k : k + n]))
                if own is not None:
                    hit |= set(range(k, k + n))
                    found |= {str(x) for x in own if x is not None}
        out.append((i, len(w), len(hit), len(found), _sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)))
    return Counter(out)


ITEMS = [
    (1, "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"),
    (10, "short ITEM"), (11, "the the the the the the the the the the the the the the the"), (12, ""), (13, None), (None, "nameless item here"), (10, "short item"),
]


def _contaminated_rows():
    base = PLAIN_WORDS.findall(low(ITEMS[0][1]))
    return [
        *corpus(20),
        (901, "x " + " ".join(base)), (902, " ".join(base[:12])), (903, "--" + "!".join(base[1:14]) + "--"),
        (904, "a short item and a SHORT, item"), (905, "the " * 14), (906, ("word " * 600) + " ".join(base)), (907, "a nameless item here"),
        (907, "a nameless item here"), (None, "short item"), (907, "another text of this id"),
    ]


@pytest.mark.parametrize("broadcast", [True, False])
def test_contamination(spark, broadcast):
    rows = _contaminated_rows()
    bench = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id bigint, text string, words int")
    if not broadcast:
        spark.conf.set("civicspark.decontaminateBroadcastRows", "0")
    try:
        got = decontaminate.contamination(documents(spark, rows), bench).collect()
    finally:
        spark.conf.unset("civicspark.decontaminateBroadcastRows")
    want = _contamination(rows, ITEMS)
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got) == want


def test_no_document_crosses_the_exchange_of_many_windows(spark):
    """Beyond the broadcast, a word that may start a match takes at most 25 words along, and few words may."""
    rows = [(i, " ".join(f"w{(i * 977 + k) % 5000}" for k in range(2000))) for i in range(30)] + [(99, "x " + ITEMS[0][1] + " y")]
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = keyed(documents(spark, rows))
    probes = spark.createDataFrame([("w7", 0, ["w7", "w8"], 2, ["a"]), ("w11", 1, ["w10", "w11"], 2, ["b"])], "word string, offset int, wanted array<string>, len int, items array<string>")
    cut = docs.select("doc_id", "_text_hash", decontaminate.words_of(F.col("text")).alias("words"))
    hits = decontaminate._shuffled_hits(cut, probes, 13)
    got = Counter((r["doc_id"], r["start"], r["items"][0]) for r in hits.collect())
    want = Counter()
    for i, t in rows:
        words = t.split()
        want.update((i, k, {"w7": "a", "w10": "b"}[w]) for k, w in enumerate(words[:-1]) if (w, words[k + 1]) in (("w7", "w8"), ("w10", "w11")))
    assert got == want and want
    plan = hits._jdf.queryExecution().optimizedPlan()
    join = next(p for p in iter_plan(plan) if p.nodeName() == "Join")
    sent = join.children().head()
    names = [sent.output().apply(k).name() for k in range(sent.output().size())]
    assert "words" not in names and {"pos", "word", "near"} <= set(names)
    bits = decontaminate._word_map(probes)
    assert len(bits) == decontaminate.MAP_BITS // 8 and sum(b.bit_count() for b in bits) == 2
    spark.conf.set("civicspark.decontaminateBroadcastRows", "0")
    try:
        assert decontaminate.contamination(documents(spark, rows), bench).where("contaminated").select("doc_id").collect() == [(99,)]
    finally:
        spark.conf.unset("civicspark.decontaminateBroadcastRows")


def iter_plan(plan):
    yield plan
    children = plan.children()
    for k in range(children.size()):
        yield from iter_plan(children.apply(k))


def test_contaminated_rows_leave(spark):
    rows = _contaminated_rows()
    docs, bench = documents(spark, rows), spark.createDataFrame(ITEMS, "item_id bigint, text string")
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns
    keep = Counter({k[0]: n for k, n in _contamination(rows, ITEMS).items() if not k[-1]})
    assert Counter(r["doc_id"] for r in left.collect()) == keep
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == len(rows)
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("name", ["op3_block_naming", "op8_decontaminate"])
def test_query_matches_oracle(spark, name):
    assert_matches_oracle(spark, SF_SMALL, name)
