"""The hierarchical classifier against brute force and on documents that it was not fitted on."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corvid.llm import hierbayes

SF = "/root/testdata/sf0.01"


def brute_means(rows):
    """(host, path): posterior mean, by the formulas on plain lists."""
    grain = lambda x: round(x * 1e6) / 1e6
    groups, hosts = defaultdict(list), defaultdict(list)
    for h, p, x in rows:
        groups[h, p].append(x)
        hosts[h].append(x)
    n = len(rows)
    total = sum(grain(x) for *_, x in rows)
    mean = total / n
    within = max(sum(grain(x * x) for *_, x in rows) / n - mean * mean, 1e-9)

    def strength(parts):
        sizes, sums = [len(v) for v in parts], [sum(map(grain, v)) for v in parts]
        between = sum(k * (s / k - mean) ** 2 for k, s in zip(sizes, sums))
        spread = (between - (len(parts) - 1) * within) / max(n - sum(k * k for k in sizes) / n, 1e-9)
        return min(within / max(spread, 1e-6), 1e6)

    kh, kp = strength(list(hosts.values())), strength(list(groups.values()))
    out = {}
    for (h, p), v in groups.items():
        own = (sum(map(grain, hosts[h])) + kh * mean) / (len(hosts[h]) + kh)
        out[h, p] = (sum(map(grain, v)) + kp * own) / (len(v) + kp)
    return mean, out


def test_shrink_against_brute_force(spark):
    r = random.Random(2)
    rows = [(h, f"{h}/{p}", min(1.0, max(0.0, r.gauss(0.2 + 0.1 * h, 0.2)))) for h in range(5) for p in range(4) for _ in range(r.randint(1, 30))]
    rows += [(None, None, 0.9), (None, None, 0.4), (7, None, 0.5)]
    frame = spark.createDataFrame([(None if h is None else str(h), p, x) for h, p, x in rows], "host string, path string, p double")
    mean, want = brute_means([(None if h is None else str(h), p, x) for h, p, x in rows])
    got = hierbayes.shrink(frame, "p").collect()
    assert len(got) == len(want)
    for x in got:
        assert x.global_mean == pytest.approx(mean, abs=1e-9) and x.path_mean == pytest.approx(want[x.host, x.path], abs=1e-6)


def test_posterior_against_brute_force(spark):
    r = random.Random(3)
    words = "alpha beta gamma delta river stone window paper".split()
    rows = [(n, " ".join([r.choice(words) for _ in range(12)] + (["vile", "scum"] if n % 4 == 0 else [])), "en", f"s{n % 3}") for n in range(120)]
    rows += [(200, None, "en", "s0"), (201, "", None, None), (None, "alpha vile", "en", "s1"), (5, rows[5][1], "en", "s2"), (300, "stone " * 400_000, "en", "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(n, int(n % 4 == 0)) for n in range(80)], "doc_id long, toxic int")
    got = hierbayes.classify(docs, labels, docs["source"], F.concat_ws("/", docs["source"], docs["lang"]), ["toxic"]).collect()
    assert len(got) == len(rows)
    mean, paths = brute_means([(x.host, x.path, x.toxic_doc) for x in got])
    logit = lambda p: math.log(min(max(p, 1e-4), 1 - 1e-4) / (1 - min(max(p, 1e-4), 1 - 1e-4)))
    for x in got:
        odds = logit(x.toxic_doc) + hierbayes.SITE_WEIGHT * (logit(paths[x.host, x.path]) - logit(mean))
        assert x.toxic == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-4)
    empty = docs.limit(0)
    assert hierbayes.classify(empty, labels, empty["source"], empty["lang"], ["toxic"]).count() == 0


def held_out_figures(spark, folder):
    """(precision, recall) on labelled documents whose labels the fit never saw, for each target."""
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    found = hierbayes.classify(docs, labels.where(~held), docs["source"], F.concat_ws("/", docs["source"], docs["lang"]), ["quality", "toxic"])
    rows = found.select("doc_id", F.col("quality").alias("q"), F.col("toxic").alias("t")).join(labels.where(held), "doc_id").collect()
    out = {}
    for name, p, y in (("quality", [x.q for x in rows], [x.quality for x in rows]), ("toxic", [x.t for x in rows], [x.toxic for x in rows])):
        hit = sum(a >= 0.5 and b for a, b in zip(p, y))
        out[name] = (hit / max(1, sum(a >= 0.5 for a in p)), hit / max(1, sum(y)), len(rows), sum(y))
    return out


def test_held_out_documents(spark):
    got = held_out_figures(spark, SF)
    assert got["quality"][0] > 0.8 and got["quality"][1] > 0.8
    assert got["toxic"][0] > 0.6 and got["toxic"][1] > 0.5
