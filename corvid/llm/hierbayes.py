"""Quality classifier: hierarchical empirical Bayes.

Document evidence: a log-odds sum over a document's distinct features (lower-cased words,
word shapes, and the share of distinct words), with weights from labelled documents for the
features whose counts differ between the classes beyond `MIN_CHI2`. It is calibrated to a
probability by a logistic fit. Site evidence: the mean of that probability for each host and
each path of a host. Prior strengths come from the data, by the method of moments: the spread
of group means beyond what their sizes explain. So a sparse path shrinks to its host, a sparse
host to the whole corpus, and a document's posterior log odds are its own plus `SITE_WEIGHT`
times those by which its path differs from the corpus.

The weights are fitted on at most MAX_LABELLED labelled documents, those with the smallest
hash of the id; everything else covers all documents.

Null or empty text: no words, so the priors alone speak. A null host or path is a group of
its own. Without labels every probability is 0.5. Rows that repeat an id are scored each, and
each counts in its site's mean; an id's repeated labels count once, the larger value of each.
An empty table gives an empty result. A text of any length is one task's. Equal hashes of ids
are taken in order of the id. Further columns are not read.
"""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stash, batch, row_slices

MAX_LABELLED = 20_000
#: Paths whose means are broadcast are fewer than this, whatever the input's size.
MOST_HOT = 10_000
BUCKETS = 1 << 18
MIN_CHI2 = 16.0
MIN_DOCS_OF_FEATURE = 8
SITE_WEIGHT = 0.5
EDGE = 1e-4

_SHAPE = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")


def features(text: str) -> set[str]:
    words = text.lower().split()
    distinct = set(words)
    out = {w.strip(".,;:!?\"'()") for w in distinct}
    out |= {"\x00" + _DIGITS.sub("0", _SHAPE.sub("a", w)) for w in distinct if not w.isalpha()}
    out.add(f"\x01{int(8 * len(distinct) / len(words)) if words else -1}")
    return out


def bucket(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature.encode("utf-8", "replace")) % BUCKETS


def fit(sample: DataFrame, targets: list[str]) -> dict:
    """Weights and calibration of each target from a bounded sample (text, target columns 0/1/null)."""
    schema = pa.schema([("target", pa.int32()), ("bucket", pa.int32()), ("n0", pa.int64()), ("n1", pa.int64())])

    def count(batches):
        n = np.zeros((len(targets), 2, BUCKETS + 1), np.int64)
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = [*{bucket(f) for f in features(row[0] or "")}, BUCKETS]
                for t, y in enumerate(row[1:]):
                    if y is not None:
                        n[t, int(y > 0), own] += 1
        for t in range(len(targets)):
            some = np.flatnonzero(n[t].sum(axis=0))
            yield batch(schema, [t] * len(some), some.astype(np.int32), n[t, 0, some], n[t, 1, some])

    counts = sample.select("text", *targets).mapInArrow(count, "target int, bucket int, n0 long, n1 long").groupBy("target", "bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    known = counts.where((F.col("n0") + F.col("n1") >= MIN_DOCS_OF_FEATURE) | (F.col("bucket") == BUCKETS)).toPandas()  # at most targets x BUCKETS rows
    model = {}
    for t, name in enumerate(targets):
        own = known[known["target"] == t]
        total = own[own["bucket"] == BUCKETS]
        if not len(total) or not (int(total["n0"].iloc[0]) and int(total["n1"].iloc[0])):
            model[name] = {"weights": {}, "a": 0.0, "b": 0.0}
            continue
        t0, t1 = float(total["n0"].iloc[0]), float(total["n1"].iloc[0])
        own = own[own["bucket"] != BUCKETS]
        a, c = own["n1"].to_numpy(float), own["n0"].to_numpy(float)
        b, d = t1 - a, t0 - c
        n = t0 + t1
        with np.errstate(divide="ignore", invalid="ignore"):
            chi2 = np.nan_to_num(n * (a * d - b * c) ** 2 / ((a + b) * (c + d) * (a + c) * (b + d)))
        odds = np.log((a + 0.5) / (t1 + 1)) - np.log((c + 0.5) / (t0 + 1))
        some = chi2 >= MIN_CHI2
        model[name] = {"weights": dict(zip(own["bucket"][some].tolist(), odds[some].tolist(), strict=True)), "a": 1.0, "b": math.log(t1 / t0)}
    return _calibrate(sample, targets, model)


def _calibrate(sample: DataFrame, targets: list[str], model: dict) -> dict:
    """Fits probability = logistic(a * evidence + b) on counts of evidence in tenths: a bounded table."""
    scored = sample.select("text", *targets).mapInArrow(_evidence(model, targets, len(targets)), ", ".join(f"e{n} double" for n in range(len(targets))) + ", " + ", ".join(f"`{t}` int" for t in targets))
    for k, name in enumerate(targets):
        if not model[name]["weights"]:
            continue
        rows = scored.where(F.col(name).isNotNull()).groupBy(F.round(F.least(F.greatest(F.col(f"e{k}"), F.lit(-100)), F.lit(100)), 1).alias("e")).agg(F.sum((F.col(name) > 0).cast("long")).alias("n1"), F.count("*").alias("n")).collect()
        x, n1, n = (np.array([r[j] for r in rows], float) for j in range(3))
        a, b = 0.5, math.log((n1.sum() + 1) / (n.sum() - n1.sum() + 1))
        for _ in range(50):  # Newton steps with a weak pull to a = 0.5
            p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
            g = np.array([((n1 - n * p) * x).sum() - (a - 0.5), (n1 - n * p).sum()])
            w = n * p * (1 - p)
            h = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-6]])
            step = np.linalg.solve(h, g)
            a, b = a + step[0], b + step[1]
            if abs(step).max() < 1e-9:
                break
        model[name] |= {"a": float(a), "b": float(b)}
    return model


_weights: dict = {}


def _evidence(model: dict, targets: list[str], extra: int):
    """Evidence of each target; the last `extra` columns go through."""
    key = repr(sorted((t, len(m["weights"]), sum(m["weights"].values())) for t, m in model.items()))

    def run(batches):
        if _weights.get("key") != key:
            _weights.clear()
            _weights.update(key=key, cache={})
        cache = _weights["cache"]
        none = (0.0,) * len(targets)

        def weight(f):
            w = cache.get(f)
            if w is None:
                k = bucket(f)
                w = tuple(model[t]["weights"].get(k, 0.0) for t in targets)
                if len(cache) > 1_000_000:
                    cache.clear()
                cache[f] = w = w if any(w) else none
            return w

        for b in row_slices(batches, 0):
            sums = []
            for text in b.column(0).to_pylist():
                some = [w for w in map(weight, features(text or "")) if w is not none]
                sums.append([math.fsum(x) for x in zip(*some, strict=True)] if some else [0.0] * len(targets))
            out = [pa.array([s[k] for s in sums], pa.float64()) for k in range(len(targets))]
            yield pa.RecordBatch.from_arrays([*out, *b.columns[-extra:]], names=[*(f"e{k}" for k in range(len(targets))), *b.schema.names[-extra:]])

    return run


def logit(p):
    q = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(q / (1 - q))


def shrink(scored: DataFrame, p: str) -> DataFrame:
    """Posterior means for each (host, path) of column p: path to host, host to the corpus.

    Grouped aggregates with partial sums: a hot host costs no more than its groups.
    """
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(F.round(F.col(p) * 1_000_000).cast("long")).alias("s"), F.sum(F.round(F.col(p) * F.col(p) * 1_000_000).cast("long")).alias("q"))
    paths = paths.select("host", "path", "n", (F.col("s") / 1e6).alias("s"), (F.col("q") / 1e6).alias("q"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("q").alias("hq"))
    every = hosts.agg(F.sum("hn").alias("gn"), F.sum("hs").alias("gs"), F.sum("hq").alias("gq"))
    mean = F.col("gs") / F.col("gn")
    within = F.greatest(F.col("gq") / F.col("gn") - mean * mean, F.lit(1e-9))

    def strength(groups: DataFrame, n: str, s: str, name: str) -> DataFrame:
        """Documents that the prior weighs: within variance over the variance between groups."""
        moments = groups.crossJoin(F.broadcast(every)).agg(
            F.max(within).alias("v"), F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - mean, 2)).alias("between"), F.sum(n).alias("all"), F.sum(F.col(n) * F.col(n)).alias("squares"), F.count("*").alias("k")
        )
        spread = (F.col("between") - (F.col("k") - 1) * F.col("v")) / F.greatest(F.col("all") - F.col("squares") / F.col("all"), F.lit(1e-9))
        return moments.select(F.least(F.col("v") / F.greatest(spread, F.lit(1e-6)), F.lit(1e6)).alias(name))

    kh, kp = strength(hosts, "hn", "hs", "host_prior"), strength(paths, "n", "s", "path_prior")
    one_row = every.crossJoin(kh).crossJoin(kp)  # a single row of totals
    hosts = hosts.crossJoin(F.broadcast(one_row)).withColumn("global_mean", mean).withColumn("host_mean", (F.col("hs") + F.col("host_prior") * mean) / (F.col("hn") + F.col("host_prior")))
    joined = paths.join(hosts.withColumnRenamed("host", "host_"), F.col("host").eqNullSafe(F.col("host_")))
    return joined.select("host", "path", "n", "hn", "global_mean", "host_mean", ((F.col("s") + F.col("path_prior") * F.col("host_mean")) / (F.col("n") + F.col("path_prior"))).alias("path_mean"))


def sample_labels(labels: DataFrame, targets: list[str], most: int = MAX_LABELLED) -> DataFrame:
    """At most `most` labelled ids, those with the smallest hash; repeated ids count once."""
    one = labels.where(labels["doc_id"].isNotNull()).groupBy("doc_id").agg(*[F.max(labels[t].cast("int")).alias(t) for t in targets])
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def classify(docs: DataFrame, labels: DataFrame, host, path, targets: list[str]) -> DataFrame:
    """Document, host and path evidence and the posterior of each target for every document."""
    stash = Stash(docs.sparkSession, "bayes")
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"), host.cast("string").alias("host"), path.cast("string").alias("path"))
    picked = stash.keep(sample_labels(labels, targets), "labels")
    sample = stash.keep(base.join(F.broadcast(picked), "doc_id").select("text", *targets), "sample")  # MAX_LABELLED ids
    model = fit(sample, targets)
    keys = base.select("text", "doc_id", "host", "path").mapInArrow(_evidence(model, targets, 3), ", ".join(f"e{k} double" for k in range(len(targets))) + ", doc_id long, host string, path string")
    for k, t in enumerate(targets):
        keys = keys.withColumn(f"{t}_doc", 1 / (1 + F.exp(-(F.lit(model[t]["a"]) * F.col(f"e{k}") + F.lit(model[t]["b"])))))
    out = stash.keep(keys.drop(*(f"e{k}" for k in range(len(targets)))), "scored")
    rows = [shrink(out, f"{t}_doc").withColumn("target", F.lit(t)) for t in targets]
    named = {"global_mean": "global", "host_mean": "host", "path_mean": "path"}
    of = [F.max(F.when(F.col("target") == t, F.col(c))).alias(f"{t}_{name}") for t in targets for c, name in named.items()]
    means = functools.reduce(DataFrame.unionByName, rows).groupBy(F.col("host").alias("h_"), F.col("path").alias("p_")).agg(F.max("n").alias("n_"), *of)
    out = beside(out, stash.keep(means, "means"))
    for t in targets:
        odds = logit(F.col(f"{t}_doc")) + SITE_WEIGHT * (logit(F.col(f"{t}_path")) - logit(F.col(f"{t}_global")))
        out = out.withColumn(t, 1 / (1 + F.exp(-odds))).drop(f"{t}_global")
    return out


def beside(scored: DataFrame, means: DataFrame, most: int = MOST_HOT) -> DataFrame:
    """Each document with the means of its (host, path).

    Paths with over 1 / most of all documents are fewer than `most`: they are broadcast, so
    their documents aren't shuffled; the others meet their means by a shuffle of even groups.
    """
    total = scored.count()
    same = F.col("host").eqNullSafe(F.col("h_")) & F.col("path").eqNullSafe(F.col("p_"))
    is_hot = F.col("n_") * most > total
    hot = F.broadcast(means.where(is_hot))
    first = scored.join(hot, same)
    rest = scored.join(hot.select("h_", "p_"), same, "left_anti").join(means.where(~is_hot), same)
    return first.unionByName(rest).drop("h_", "p_", "n_")
