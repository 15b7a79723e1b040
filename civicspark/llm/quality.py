"""Quality classifier: document evidence shrunk towards site posteriors.

Two linear heads (low quality, toxic) are fitted on a bounded sample of the
labelled documents: a few figures of the text's style, and the words and word
beginnings that tell the classes apart, weighted by their log count ratio. How
much evidence a word must show is chosen on a part of the sample that is set
aside. All documents are then scored.

Sites follow in a hierarchy of empirical Bayes estimates. The scores of a
host's documents, and of a path within it, are averaged by grouped
aggregation; the spread of these averages over all sites, beyond what chance
explains, gives the weight of the prior at each level. A path is shrunk to its
host and a host to the global mean, the more the fewer documents it has. A
document's verdict combines its own odds with those of its path.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from civicspark.llm.common import byte_slices, hash_words, mix64, neutral, releasing, split_words
from civicspark.session import materialize, tuning

#: Most labelled documents the heads are fitted on (those with the smallest hash of their id).
MAX_TRAINING = 10_000
#: Lexical features are hashed into so many places.
FEATURE_BITS = 18
#: Evidence (log-likelihood ratio) tried as the least for a lexical feature; infinite: style only.
LEAST_EVIDENCE = (math.inf, 60.0, 30.0, 15.0, 8.0)
#: Steps of each fit.
ROUNDS = 300
#: Letters of a word's beginning.
PREFIX = 4
HEADS = ("low", "toxic")
#: Site columns of ``documents``, the host first.
SITE_LEVELS = ("source", "lang")
#: Posterior from which a document is rejected.
REJECT = 0.5
#: Sites up to which their posteriors are broadcast; more are joined by a shuffle.
BROADCAST_SITES = 100_000

SLICE_BYTES = 2 << 20
_TRIM = ".,;:!?\"'()[]|%*&$#"
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Largest log odds a probability is taken for.
_LOGIT_LIMIT = 12.0


# -- features -------------------------------------------------------------------

_CLASSES = ("upper", "lower", "digit", "space", "mark", "high")


def _byte_classes() -> np.ndarray:
    """One row per class, one column per byte value."""
    b = np.arange(256)
    upper, lower, digit = ((b >= lo) & (b <= hi) for lo, hi in ((65, 90), (97, 122), (48, 57)))
    space, high = np.isin(b, [9, 10, 11, 12, 13, 32]), b >= 128
    mark = ~(upper | lower | digit | space | high) & ~np.isin(b, [ord("."), ord(",")])
    return np.stack([upper, lower, digit, space, mark, high]).astype(np.uint8)


_BYTE_CLASSES = _byte_classes()


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Style figures (one row per text), and the lexical features of all texts in a row with their starts."""
    texts = pc.fill_null(texts, "")
    n = len(texts)
    size = np.asarray(pc.binary_length(texts), dtype=np.int64)
    data = np.frombuffer(b"".join(t.as_buffer() for t in texts), np.uint8)
    starts = np.concatenate([[0], np.cumsum(size)])
    count = {}
    for name, row in zip(_CLASSES, _BYTE_CLASSES, strict=True):
        total = np.concatenate([[0], np.cumsum(row[data], dtype=np.int64)])
        count[name] = total[starts[1:]] - total[starts[:-1]]
    words, codes, offsets = split_words(texts)
    n_words = np.diff(offsets)
    owner = np.repeat(np.arange(n), n_words)

    # Distinct words of each text and how often each occurs there.
    pair, times = np.unique(owner * max(1, len(words)) + codes, return_counts=True)
    own, word = pair // max(1, len(words)), pair % max(1, len(words))
    distinct = np.bincount(own, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, own, times)

    again = np.zeros(n)  # words that repeat the one before
    repeat = np.flatnonzero((codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1]))
    np.add.at(again, owner[repeat], 1)
    some_words, letters = np.maximum(n_words, 1), np.maximum(count["upper"] + count["lower"], 1)
    some_bytes = np.maximum(size, 1)
    style = np.stack(
        [
            np.ones(n), np.log1p(n_words) / 5, distinct / some_words, most / some_words, again / some_words,
            count["upper"] / letters, count["digit"] / some_bytes, count["mark"] / some_bytes, count["space"] / some_bytes,
            count["high"] / some_bytes, np.minimum(size / some_words / 10, 3),
        ],
        axis=1,
    )

    clean = pc.utf8_trim(words.cast(pa.string()), _TRIM)
    heads = pc.utf8_slice_codeunits(clean, 0, PREFIX)
    place = lambda h: (mix64(h) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    whole, head = place(hash_words(clean)), place(hash_words(heads) * _STEP)
    lexical = np.unique(np.concatenate([own * (1 << FEATURE_BITS) + whole[word], own * (1 << FEATURE_BITS) + head[word]])) if n else pair
    return style, lexical % (1 << FEATURE_BITS), np.searchsorted(lexical // (1 << FEATURE_BITS), np.arange(n + 1))


# -- the two heads ----------------------------------------------------------------


@dataclass(frozen=True)
class Head:
    """A linear model; ``None`` weights say that the sample held one class only, so there is no evidence."""

    style: np.ndarray | None
    lexical: np.ndarray | None

    def probabilities(self, style: np.ndarray, lexical: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if self.style is None:
            return np.zeros(len(style))
        total = np.concatenate([[0.0], np.cumsum(self.lexical[lexical])])
        return _sigmoid(style @ self.style + total[starts[1:]] - total[starts[:-1]])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def _evidence(lexical: np.ndarray, row: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per lexical feature its log count ratio and the log-likelihood ratio of its dependence on the class."""
    size = 1 << FEATURE_BITS
    n, pos = len(y), y.sum()
    support = np.bincount(lexical, minlength=size).astype(np.float64)
    hit = np.bincount(lexical, weights=y[row], minlength=size)
    ratio = np.log((hit + 0.5) / (pos + 1.0)) - np.log((support - hit + 0.5) / (n - pos + 1.0))
    table = np.stack([hit, support - hit, pos - hit, n - pos - support + hit])
    expected = np.stack([support * pos, support * (n - pos), (n - support) * pos, (n - support) * (n - pos)]) / n
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = np.where(table > 0, table * np.log(table / expected), 0.0)
    return ratio, 2 * terms.sum(axis=0)


def _descend(style: np.ndarray, row: np.ndarray, column: np.ndarray, value: np.ndarray, width: int, y: np.ndarray) -> np.ndarray:
    """Logistic regression over style figures and weighted lexical features (Adam, full batch)."""
    k = style.shape[1]
    weight = np.zeros(k + width)
    first, second = np.zeros_like(weight), np.zeros_like(weight)
    penalty = np.full(k + width, 1.0 / len(y))
    penalty[0] = 0.0
    for step in range(1, ROUNDS + 1):
        z = style @ weight[:k] + np.bincount(row, weights=value * weight[k:][column], minlength=len(y))
        error = (_sigmoid(z) - y) / len(y)
        gradient = np.concatenate([style.T @ error, np.bincount(column, weights=value * error[row], minlength=width)]) + penalty * weight * 0.1
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        weight -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return weight


def _fit_with(style: np.ndarray, lexical: np.ndarray, row: np.ndarray, y: np.ndarray, least_evidence: float) -> Head:
    """A head over the style and the lexical features with at least that much evidence."""
    mean, spread = style.mean(axis=0), style.std(axis=0) + 1e-9
    mean[0], spread[0] = 0.0, 1.0  # the constant
    ratio, evidence = _evidence(lexical, row, y)
    used = evidence[lexical] >= least_evidence
    names, column = np.unique(lexical[used], return_inverse=True)
    weight = _descend((style - mean) / spread, row[used], column, ratio[names][column], len(names), y)
    k = style.shape[1]
    out = np.zeros(1 << FEATURE_BITS)
    out[names] = weight[k:] * ratio[names]
    plain = weight[:k] / spread
    plain[0] -= (plain[1:] * mean[1:]).sum()
    return Head(plain, out)


def _log_loss(p: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


@dataclass(frozen=True)
class Sample:
    """Features and classes of the sampled documents that have a label for a head."""

    style: np.ndarray
    lexical: np.ndarray
    starts: np.ndarray
    y: np.ndarray

    @property
    def one_class(self) -> bool:
        return len(self.y) == 0 or self.y.min() == self.y.max()

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.y), dtype=np.int32), np.diff(self.starts))

    def trial(self, least: float) -> float:
        """Log loss, on a fifth of the sample, of a head with that evidence threshold fitted on the others; infinite if they are of one class."""
        aside = np.arange(len(self.y)) % 5 == 4
        learn = ~aside
        if self.one_class or self.y[learn].min() == self.y[learn].max() or not aside.any():
            return math.inf
        row, of = self.rows(), (np.cumsum(learn) - 1).astype(np.int32)
        mine = learn[row]
        head = _fit_with(self.style[learn], self.lexical[mine], of[row[mine]], self.y[learn], least)
        return _log_loss(head.probabilities(self.style, self.lexical, self.starts)[aside], self.y[aside])

    def head(self, least: float) -> Head:
        """The head with that evidence threshold, fitted on the whole sample."""
        return Head(None, None) if self.one_class else _fit_with(self.style, self.lexical, self.rows(), self.y, least)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_training: int = MAX_TRAINING) -> dict[str, Head]:
    """Both heads from at most ``max_training`` labelled documents.

    ``labels`` has ``doc_id, quality (1 good), toxic (1 toxic)``. Repeated
    labels of a document count by majority, ties as the worse label; null
    labels are left out of their head. Labels without a document are ignored.
    A head whose sample has one class only rejects nothing. The evidence
    threshold of a head is the one that does best on a fifth of the sample that
    is set aside; all trials of both heads run as tasks of one job, and so do
    the two fits on the whole sample. The sample reaches them by a broadcast:
    its size is bounded by ``max_training``.
    """
    worse = F.when(F.avg(1 - F.col("quality")) >= 0.5, 1.0).when(F.avg(1 - F.col("quality")) < 0.5, 0.0)
    toxic = F.when(F.avg("toxic") >= 0.5, 1.0).when(F.avg("toxic") < 0.5, 0.0)
    named = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_label_id")).agg(worse.alias("low"), toxic.alias("toxic"))
    chosen = materialize(named.orderBy(F.xxhash64("_label_id"), "_label_id").limit(max_training), "training-labels")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_label_id")).dropDuplicates(["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                style, lexical, starts = features(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(lexical, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("low"), part.column("toxic"), pa.array(list(style), pa.list_(pa.float64())), lists],
                    names=["doc_id", "low", "toxic", "style", "lexical"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    sample = rows.select("doc_id", "low", "toxic", "text").mapInArrow(releasing(run), f"doc_id {kind}, low double, toxic double, style array<double>, lexical array<int>")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_as_bytes(sample.toArrow()))
    try:
        tried = _in_tasks(spark, [(h, least) for h in HEADS for least in LEAST_EVIDENCE], shared, _trial, _TRIAL)
        best = {h: min((r["loss"], r["least"]) for r in tried if r["head"] == h) for h in HEADS}
        chosen = [(h, best[h][1] if math.isfinite(best[h][0]) else LEAST_EVIDENCE[-1]) for h in HEADS]
        fitted = _in_tasks(spark, chosen, shared, _whole_fit, _FIT)
    finally:
        shared.unpersist()
    return {r["head"]: _unpacked(r) for r in fitted}


_TRIAL = pa.schema([("head", pa.string()), ("least", pa.float64()), ("loss", pa.float64())])
_FIT = pa.schema([("head", pa.string()), ("style", pa.list_(pa.float64())), ("places", pa.list_(pa.int32())), ("weights", pa.list_(pa.float64()))])


def _as_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def _in_tasks(spark: SparkSession, work: list[tuple[str, float]], shared: Broadcast, do: Callable, schema: pa.Schema) -> list[Row]:
    """``do(sample, head, least)`` for every item of work, a task each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column("id").to_pylist():
                head, least = work[i]
                yield pa.RecordBatch.from_pylist([do(_sample_of(shared.value, head), head, least)], schema=schema)

    return spark.range(0, len(work), 1, len(work)).mapInArrow(releasing(run), from_arrow_schema(schema)).collect()  # a row per item


def _trial(sample: Sample, head: str, least: float) -> dict:
    return {"head": head, "least": least, "loss": sample.trial(least)}


def _whole_fit(sample: Sample, head: str, least: float) -> dict:
    """The fitted head; of its lexical weights those that are not 0."""
    found = sample.head(least)
    if found.style is None:
        return {"head": head, "style": None, "places": None, "weights": None}
    places = np.flatnonzero(found.lexical)
    return {"head": head, "style": found.style, "places": places, "weights": found.lexical[places]}


def _unpacked(r: Row) -> Head:
    if r["style"] is None:
        return Head(None, None)
    lexical = np.zeros(1 << FEATURE_BITS)
    lexical[r["places"]] = r["weights"]
    return Head(np.array(r["style"]), lexical)


def _sample_of(table: bytes, name: str) -> Sample:
    """The sampled rows that have a label of a head, in order of their ids."""
    sample = pa.ipc.open_stream(table).read_all()
    sample = sample.filter(pc.is_valid(sample.column(name)))
    sample = sample.take(pc.sort_indices(sample.column("doc_id"))).combine_chunks()
    style = np.array(sample.column("style").to_pylist(), dtype=np.float64).reshape(sample.num_rows, -1 if sample.num_rows else 1)
    lists = sample.column("lexical").combine_chunks()
    starts = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), dtype=np.int64))])
    return Sample(style, np.asarray(lists.flatten()), starts, np.asarray(sample.column(name), dtype=np.float64))


def score(docs: DataFrame, heads: dict[str, Head], text_col: str = "text") -> DataFrame:
    """``docs`` plus ``p_low, p_toxic``, each document's own evidence. Columns of these names are replaced.

    A null text is empty. One Arrow pass; the heads are of a fixed size
    (``2 ** FEATURE_BITS`` weights each) and travel with the task.
    """
    new = [f"p_{h}" for h in HEADS]
    kept = [f for f in docs.schema.fields if f.name not in new]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, *(T.StructField(n, T.DoubleType(), False) for n in new)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, text_col, SLICE_BYTES):
                found = features(part.column(text_col))
                p = [pa.array(heads[h].probabilities(*found)) for h in HEADS]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *p], names=[*names, *new])

    return docs.select(*(f"`{n}`" for n in names)).mapInArrow(releasing(run), schema)


# -- sites --------------------------------------------------------------------------


@dataclass(frozen=True)
class Sites:
    """``table``: per path its key columns and posteriors ``s_<head>``; ``priors``: the global means."""

    table: DataFrame
    n_sites: int
    levels: tuple[str, ...]
    priors: dict[str, float]


def _site_key(level: str) -> Column:
    return F.coalesce(F.col(f"`{level}`").cast("string"), F.lit(""))


def _prior_weights(groups: DataFrame, above: str, means: dict[str, float]) -> dict[str, float]:
    """Method of moments: documents that the prior is worth at a level, from the spread of its groups' means.

    ``groups`` has ``n``, the sums ``s_<head>`` and ``q_<head>`` (of squares)
    and the level above's posterior ``<above><head>``. No spread beyond chance
    gives an infinite weight.
    """
    terms = []
    for h in HEADS:
        mean = F.col(f"s_{h}") / F.col("n")
        chance = (F.col(f"q_{h}") / F.col("n") - mean * mean) / F.col("n")
        terms += [F.sum(F.col("n") * (F.pow(mean - F.col(f"{above}{h}"), 2) - chance)).alias(f"v_{h}")]
    row = groups.agg(F.sum("n").alias("n"), *terms).first()
    out = {}
    for h in HEADS:
        spread = (row[f"v_{h}"] or 0.0) / max(1, row["n"] or 0)
        m = min(max(means[h], 1e-6), 1 - 1e-6)
        out[h] = m * (1 - m) / spread if spread > 1e-12 else math.inf
    return out


def _shrunk(h: str, weight: float, above: str) -> Column:
    if math.isinf(weight):
        return F.col(f"{above}{h}")
    return (F.lit(weight) * F.col(f"{above}{h}") + F.col(f"s_{h}")) / (F.lit(weight) + F.col("n"))


def site_posteriors(scored: DataFrame, levels: Sequence[str] = SITE_LEVELS) -> Sites:
    """Posterior means of every path (all ``levels``), shrunk level by level towards the global mean.

    Null site columns are a site named ''. An empty table has no sites.
    """
    levels = tuple(levels)
    keys = [f"_site{i}" for i in range(len(levels))]
    sums = [F.count(F.lit(1)).alias("n")]
    for h in HEADS:
        sums += [F.sum(f"p_{h}").alias(f"s_{h}"), F.sum(F.col(f"p_{h}") * F.col(f"p_{h}")).alias(f"q_{h}")]
    paths = materialize(scored.groupBy(*(_site_key(c).alias(k) for c, k in zip(levels, keys, strict=True))).agg(*sums), "site-sums")
    parts = ["n", *(f"{x}_{h}" for h in HEADS for x in "sq")]
    total = paths.agg(*(F.sum(c).alias(c) for c in parts)).first()
    n = total["n"] or 0
    means = {h: (total[f"s_{h}"] or 0.0) / n if n else 0.0 for h in HEADS}
    posterior = None
    for depth in range(1, len(levels) + 1):
        at = keys[:depth]
        groups = paths.groupBy(*at).agg(*(F.sum(c).alias(c) for c in parts))
        if posterior is None:
            groups = groups.select("*", *(F.lit(means[h]).alias(f"above_{h}") for h in HEADS))
        else:
            groups = groups.join(posterior, at[:-1])
        groups = materialize(groups, "site-level")
        weights = _prior_weights(groups, "above_", means)
        posterior = groups.select(*at, *(_shrunk(h, weights[h], "above_").alias(f"above_{h}") for h in HEADS))
    table = materialize(posterior.select(*keys, *(F.col(f"above_{h}").alias(f"site_{h}") for h in HEADS)), "site-posteriors")
    return Sites(table, table.count(), levels, means)


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.greatest(F.least(F.log(p / (1 - p)), F.lit(_LOGIT_LIMIT)), F.lit(-_LOGIT_LIMIT))


def judge(scored: DataFrame, sites: Sites, reject: float = REJECT) -> DataFrame:
    """``scored`` plus ``site_low, site_toxic, post_low, post_toxic, kept``.

    A document's posterior odds are its own odds times its path's posterior
    odds over the global ones. A head without evidence (all scores 0) rejects
    nothing.
    """
    keys = [f"_site{i}" for i in range(len(sites.levels))]
    limit = tuning(scored.sparkSession, "qualityBroadcastSites", BROADCAST_SITES)
    table = F.broadcast(sites.table) if sites.n_sites <= limit else sites.table
    new = [f"{x}_{h}" for x in ("site", "post") for h in HEADS]
    base = scored.drop(*new, "kept").select("*", *(_site_key(c).alias(k) for c, k in zip(sites.levels, keys, strict=True)))
    out = base.join(table, keys, "left")
    rejected = F.lit(False)
    for h in HEADS:
        shift = _logit(F.col(f"site_{h}")) - _logit(F.lit(sites.priors[h]))
        odds = _logit(F.col(f"p_{h}")) + shift
        out = out.withColumn(f"post_{h}", F.when(F.col(f"p_{h}") > 0, 1 / (1 + F.exp(-odds))).otherwise(0.0))
        rejected = rejected | (F.col(f"post_{h}") >= reject)
    return out.withColumn("kept", ~rejected).drop(*keys)


def drop_low_quality(
    docs: DataFrame, labels: DataFrame, levels: Sequence[str] = SITE_LEVELS, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns, whatever their names.

    Texts are scored once for the site averages and again for the verdicts,
    which is cheaper than shuffling them to join the scores. A null text is
    empty, a null id is a row without a label, a null site column is a site
    named ''. Repeated rows get one verdict each. Very long texts are scored
    whole, one at a time. An empty table gives an empty result; without labels
    nothing is dropped.
    """
    plain, (text, doc_id, *sites_cols), back = neutral(docs, text_col, id_col, *levels)
    heads = fit(plain, labels, id_col=doc_id, text_col=text)
    narrow = plain.select(F.col(text).alias("text"), *sites_cols)
    sites = site_posteriors(score(narrow, heads), sites_cols)
    return back(judge(score(plain, heads, text), sites).where("kept"))
