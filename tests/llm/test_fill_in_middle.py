"""Fill-in-middle transformation against plain Python."""

import hashlib
import random
import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from civicspark.llm import fill_in_middle as M
from civicspark.llm import queries
from tests.conftest import SF_SMALL
from tests.llm.frames import corpus, documents
from tests.oracle_check import assert_matches_oracle

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def _draws(doc_id, seed=42):
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def _plain_python(doc_id, text, how=M.FillInMiddle()):  # noqa: B008
    text = text or ""
    units = UNITS.findall(text)
    h1, h2, h3, h4 = _draws(doc_id, how.seed)
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    marks = (how.prefix, how.suffix, how.middle)
    if not text or any(x in text for x in marks) or h3 % 100 >= how.rate:
        return (doc_id, len(units), "plain", None, None, text)
    if h4 % 100 < how.suffix_first:
        return (doc_id, len(units), "spm", len(p), len(m), f"{how.suffix}{s}{how.prefix}{p}{how.middle}{m}")
    return (doc_id, len(units), "psm", len(p), len(m), f"{how.prefix}{p}{how.suffix}{s}{how.middle}{m}")


ODD = ["<P> in it", "ends <M", "<", ">", "a <S>b", " lead", "trail \n", "\x1e\x1f\x1c", "\x85\xa0 x", "\x00 y", "漢 字\t👍🏽", " private", "a\\1 b\\2"]


def _rows():
    rows = corpus(30) + [(1000 + i, t) for i, t in enumerate(ODD * 6)]
    return rows + [(None, "no id here"), (None, "no id here"), (None, None), (7, rows[7][1])]


@pytest.mark.parametrize("how", [M.FillInMiddle(), M.FillInMiddle(seed=7, rate=100, suffix_first=0), M.FillInMiddle(rate=100, suffix_first=100, prefix="[[p", suffix="s", middle="⁣")])
def test_outputs_are_those_of_plain_python(spark, how):
    rows = _rows()
    docs = documents(spark, rows).withColumn("output", F.lit("clash")).withColumn("form", F.lit(1)).withColumn("h1", F.lit("x"))
    got = M.fill_in_middle(docs, how, restored_col="restored").collect()
    key = lambda r: tuple(repr(x) for x in r)
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((_plain_python(i, t, how) for i, t in rows), key=key)
    assert sorted((repr(r["doc_id"]), r["restored"]) for r in got) == sorted((repr(i), t or "") for i, t in rows)
    assert M.fill_in_middle(docs.limit(0), how, restored_col="restored").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x1e\x1f<PSM>é漢", max_size=40), max_size=8), st.randoms())
def test_any_batch_comes_back(texts, rnd):
    draws = {f"h{k}": pa.array([rnd.randrange(2**32) for _ in texts], pa.int64()) for k in range(1, 5)}
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string()), **draws})
    out = M.transform(batch, M.FillInMiddle(rate=100))
    assert M.restore(out.column("output"), out.column("form"), M.FillInMiddle()).to_pylist() == texts


def test_units_are_cut_where_words_end():
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("ab \n\x0bé\x85") for _ in range(rnd.randrange(30))) for _ in range(300)]
    assert M.units(pa.array(texts)).to_pylist() == [UNITS.findall(t) for t in texts]
    assert M.units(pa.array(["skipped", *texts, "skipped"]).slice(1, len(texts))).to_pylist() == [UNITS.findall(t) for t in texts]


def test_a_batch_of_all_control_characters_gets_another_separator():
    texts = pa.array(["".join(map(chr, range(32))), " x"])
    assert M.separator(texts) == ""
    assert M.units(texts).to_pylist() == [UNITS.findall(t) for t in texts.to_pylist()]


def test_query_matches_oracle(spark):
    assert_matches_oracle(spark, SF_SMALL, "op11_fill_in_middle")
    assert queries.op11_fill_in_middle(spark, SF_SMALL).where("output_sha256 <> restored_sha256").count() > 0
