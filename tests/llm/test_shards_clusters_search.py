"""Sharding, k-means over a VA-file and ranked search against brute force."""

import math
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haulbook.llm import nra, sharding, vafile
from haulbook.llm.common import ship
from haulbook.llm.queries import QUERIES


@pytest.fixture
def shipped(spark):
    ship(spark)
    return spark


# --- sharding


@pytest.mark.parametrize(
    ("total", "marked", "drawn"), [(50, 20, 10), (50, 49, 30), (7, 7, 3), (9, 0, 4), (40, 5, 40), (1000, 40, 500), (0, 0, 0)]
)
def test_hypergeometric_draws_have_the_exact_law(spark, total, marked, drawn):
    n = 4000
    args = [F.lit(x).cast("long") for x in (total, marked, drawn)]
    draws = spark.range(n).select(sharding.hypergeometric(*args, (F.col("id") + 0.5) / n).alias("k"))
    found = Counter(r["k"] for r in draws.collect())
    for k in range(0, marked + 2):
        exact = math.comb(marked, k) * math.comb(total - marked, drawn - k) / math.comb(total, drawn) if 0 <= k <= drawn else 0
        assert abs(found[k] / n - exact) <= 1.5 / n + 1e-9


def test_large_hypergeometric_draws(spark):
    args = [F.lit(x).cast("long") for x in (10**11, 4 * 10**9, 5 * 10**6)]
    draws = spark.range(400).select(sharding.hypergeometric(*args, sharding.uniform(1, F.col("id"))).alias("k"))
    k = np.array([r["k"] for r in draws.collect()])
    mean, sd = 5e6 * 0.04, math.sqrt(5e6 * 0.04 * 0.96)
    assert abs(k.mean() - mean) < 4 * sd / 20 and 0.85 < k.std() / sd < 1.15


@pytest.mark.parametrize("blocks", [1, 3, 40, 300])
def test_matrix_has_the_sizes_of_blocks_and_shards(spark, blocks):
    rng = np.random.default_rng(blocks)
    sizes = rng.integers(0, 90, blocks)
    sizes[0] += 1
    if blocks > 3:
        sizes[blocks // 2] = 4000  # a third of the rows or more
    total = int(sizes.sum())
    quotas = [total // 7 + (s < total % 7) for s in range(7)]
    df = spark.createDataFrame([(i, int(n)) for i, n in enumerate(sizes) if n], "block long, n long")
    found = {r["block"]: r["counts"] for r in sharding.communication_matrix(df, quotas).collect()}
    assert {b: sum(c) for b, c in found.items()} == {i: n for i, n in enumerate(sizes) if n}
    assert np.array(list(found.values())).sum(0).tolist() == quotas
    assert min(map(min, found.values())) >= 0


def shards_of(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    return by


def test_shards_are_exact_and_complete(spark):
    rows = [(i % 4000 if i % 3 else 7, None if i % 10 == 0 else "x" * (i % 50), i, i % 24, "kept") for i in range(10_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long, shard int, _at string").repartition(9)
    out = sharding.into_shards(df, 24, cell_rows=50)
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().executedPlan().toString())
    got = out.collect()
    assert sorted(map(repr, [(r["doc_id"], r["text"], r["n"], r["_at"]) for r in got])) == sorted(
        map(repr, [(a, b, c, e) for a, b, c, _, e in rows])
    )
    by = shards_of(got)
    assert sorted(map(len, by.values())) == [416] * 8 + [417] * 16
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert out.collect() is not None and {(r["n"], r["shard"], r["slot"]) for r in out.collect()} == {
        (r["n"], r["shard"], r["slot"]) for r in got
    }
    # rows of one value, and neighbours, are spread like any others
    equal = Counter(r["shard"] for r in got if r["doc_id"] == 7)
    mean = sum(equal.values()) / 24
    assert sum((equal[s] - mean) ** 2 / mean for s in range(24)) < 60  # chi-square, 23 degrees of freedom
    from_block = Counter((r["n"] * 9 // len(rows), r["shard"]) for r in got)
    mean = len(rows) / 9 / 24
    assert sum((from_block[b, s] - mean) ** 2 / mean for b in range(9) for s in range(24)) < 280  # 184 degrees of freedom
    place = {r["n"]: r["slot"] for r in got}
    order = np.array([place[i] for i in range(len(rows))])
    assert abs(np.corrcoef(order[:-1], order[1:])[0, 1]) < 0.05 and abs(np.corrcoef(order, range(len(rows)))[0, 1]) < 0.05


def test_partitions_are_permuted_before_they_are_cut(spark):
    """Neighbours in a partition go to shards on their own: pieces of the input against shards, chi-square."""
    got = sharding.into_shards(spark.range(0, 12_000, 1, 3), 6).collect()
    found = Counter((r["id"] // 300, r["shard"]) for r in got)
    mean = 300 / 6
    assert sum((found[p, s] - mean) ** 2 / mean for p in range(40) for s in range(6)) < 275  # 195 degrees of freedom
    shards = {r["id"]: r["shard"] for r in got}
    same = sum(shards[i] == shards[i + 1] for i in range(11_999)) / 11_999
    assert abs(same - 1 / 6) < 0.02


def test_few_and_no_rows_in_shards(spark):
    few = sharding.into_shards(spark.range(3), 24).collect()
    assert sorted((r["shard"], r["slot"]) for r in few) == [(0, 0), (1, 0), (2, 0)]
    same = spark.createDataFrame([(None, None)] * 50, "doc_id long, text string")
    assert sorted(map(len, shards_of(sharding.into_shards(same, 4).collect()).values())) == [12, 12, 13, 13]
    none = sharding.into_shards(same.filter("false"), 24)
    assert none.count() == 0 and none.columns == ["doc_id", "text", "shard", "slot"]


def test_written_shards(spark, tmp_path):
    sharding.write_shards(spark.range(1000), str(tmp_path / "out"), 5, cell_rows=70)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r["id"] for r in got) == list(range(1000))
    assert {s: sorted(x) == list(range(200)) for s, x in shards_of(got).items()} == dict.fromkeys(range(5), True)


def test_sharding_query(shipped, small):
    got = QUERIES["op11_sharding"](shipped, small).collect()
    texts = {r["doc_id"]: r["text"] for r in shipped.read.parquet(f"{small}/documents.parquet").collect()}
    assert len(got) == len(texts)
    assert all(r["size"] == len((texts[r["doc_id"]] or "").encode()) + 8 and r["law"] == "rows" for r in got)
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1


# --- k-means


def plain_k_means(rows, k=8, rounds=10, seed=3):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    order = sorted(kept, key=lambda r: (r[0] is None, sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = np.array([v for _, v in order[:k]], np.int64)
    x = np.array([v for _, v in kept], np.int64)
    far = lambda: ((x[:, None] - centroids[None]) ** 2).sum(2)
    for _ in range(rounds):
        nearest = far().argmin(1)
        for c in range(len(centroids)):
            if (nearest == c).any():
                centroids[c] = x[nearest == c].sum(0) // (nearest == c).sum()
    d = far()
    nearest = d.argmin(1)
    own = d[np.arange(len(x)), nearest]
    names = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return [
        (kept[i][0], int(c), int(own[i]), int(own[nearest == c].sum()), int(own.sum()), names[c]) for i, c in enumerate(nearest)
    ]


def table_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_clusters_equal_brute_force(shipped):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(700, 6)) + rng.integers(-2, 3, (700, 1))
    points[200:430] = points[3] + rng.normal(size=(230, 6)) * 1e-3  # a third are near copies
    points[430:480] = points[4]  # equal ones
    points[480] = 90_000.0  # far from all cells
    rows = [(i, v) for i, v in enumerate(points.tolist())] + [(7, points[9].tolist()), (None, points[10].tolist()), (3, points[3].tolist())]
    odd = [(900, None), (901, [1.0]), (902, [None] + [0.0] * 5), (903, [math.nan] + [0.0] * 5), (904, [math.inf] * 6), (905, [1e300] * 6)]
    df = shipped.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("mine"))
    want = sorted(plain_k_means(rows), key=repr)
    for bits in (1, 4, 8):
        assert table_of(vafile.clusters(df, dimensions=6, bits=bits)) == want
    assert table_of(vafile.clusters(df, dimensions=6, k=3, rounds=2)) == sorted(plain_k_means(rows, 3, 2), key=repr)


def test_few_and_no_vectors(shipped):
    df = shipped.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, [-4.0, 0.0])], "vec_id long, embedding array<float>")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert table_of(vafile.clusters(df, dimensions=2)) == sorted(plain_k_means(rows), key=repr)
    none = vafile.clusters(df.filter("false"), dimensions=2)
    assert none.count() == 0 and none.columns == vafile.clusters(df, dimensions=2).columns


def test_intervals_hold_the_distance_and_leave_few_open():
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(3000, 16)) * 500 + rng.integers(0, 4, (3000, 1)) * 1500).astype(np.int64)
    cells = vafile.Cells(np.quantile(x, np.arange(1, 16) / 16, axis=0, method="nearest").T, x.min(0), x.max(0), 4)
    centroids = x[:5]
    code = cells.of(x)
    assert (cells.unpack(np.stack([np.frombuffer(b, np.uint8) for b in cells.pack(code)]), 16) == code).all()
    far, (least, most) = vafile.distances(x, centroids), cells.tables(centroids)
    sums = [sum(t[d][code[:, d]] for d in range(16)) for t in (least, most)]
    assert (sums[0] <= far).all() and (far <= sums[1]).all()
    left = cells.open(code, (least, most))
    assert left[np.arange(len(x)), far.argmin(1)].all() and left.sum(1).mean() < 2.5


def test_only_row_numbers_are_shuffled_for_the_fetch(shipped):
    rows = shipped.range(20_000).select(F.col("id").alias("row"), F.lit(1).alias("vec_id"), F.array(F.lit(1)).alias("v"))
    vectors = vafile.bucketed(rows, 20_000, "some_vectors")
    wanted = shipped.range(20_000).select(F.col("id").alias("row"), F.lit(1).alias("old"))
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        shipped.conf.set(name, "-1")
    try:
        plan = vectors.join(wanted, "row")._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in names:
            shipped.conf.unset(name)
        shipped.sql("DROP TABLE some_vectors")
    side = plan[: plan.index("Range")]
    assert "SelectedBucketsCount" in plan and "Exchange" not in side[: side.index("SelectedBucketsCount")].split("FileScan")[0]


def test_cluster_query_equals_brute_force(shipped, small):
    rows = [(r["vec_id"], r["embedding"]) for r in shipped.read.parquet(f"{small}/embeddings.parquet").collect()]
    rows = [(i, v) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    assert table_of(QUERIES["op12_va_file"](shipped, small)) == sorted(plain_k_means(rows), key=repr)
    assert not [t for t in shipped.catalog.listTables() if t.name.startswith("haulbook_vectors")]


# --- ranked search


def plain_terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_search(docs, items, k):
    bags = [(i, Counter(plain_terms(t))) for i, t in docs]
    lengths = [b.total() for _, b in bags]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, b in bags for t in b)
    asked = defaultdict(set)
    for i, t in items:
        asked[i].update(plain_terms(t))
    out = []
    for item, ts in asked.items():
        scores = []
        for (i, bag), size in zip(bags, lengths, strict=True):
            m = 100 - 50 + (50 * size * n) // total if total else 0
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m))
                for t in ts
                if t in bag
            )
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("k", "block_chars", "at_once"), [(5, 400, 40), (50, 3000, 100_000), (3, 10**7, 7)])
def test_search_equals_brute_force(shipped, k, block_chars, at_once):
    rng = np.random.default_rng(k)
    words = [f"w{i}" for i in range(60)] + ["É", "straße", "x1"]
    chance = 1 / np.arange(1, len(words) + 1)
    text = lambda n: " ".join(rng.choice(words, n, p=chance / chance.sum()))
    docs = [(i, text(rng.integers(0, 60)).title() + "; end's-of 9") for i in range(300)]
    docs += [(300 + i, "w1 w2 w40 w41, w50") for i in range(150)]  # a third of all are copies: ties
    docs += [(500, None), (501, ""), (502, "  \x00-!"), (503, "w3 " * 4000), (None, docs[5][1]), (5, docs[5][1]), (5, "w7 w8")]
    items = [(i, text(12) + ". " + docs[i * 3][1][:80]) for i in range(12)]
    items += [(99, None), (98, "unknown words only"), (97, "w40 W41 w50"), (3, "w59"), (None, "w58 w1"), (96, "..")]
    left = shipped.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("x"), "block": F.lit(1)})
    right = shipped.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0))
    got = nra.search(left.repartition(5), right, k, block_chars=block_chars, terms_at_once=at_once)
    assert table_of(got) == plain_search(docs, items, k)


def test_search_of_no_documents_or_items(shipped):
    docs = shipped.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = shipped.createDataFrame([(1, "a")], "item_id int, text string")
    for d, i in ((docs.filter("false"), items), (docs, items.filter("false")), (docs.withColumn("text", F.lit("-")), items)):
        none = nra.search(d, i)
        assert none.count() == 0 and none.columns == ["item_id", "rank", "doc_id", "score"]
    assert table_of(nra.search(docs, items)) == plain_search([(1, "a b")], [(1, "a")], 50)


def test_terms_across_pieces(monkeypatch):
    text = "Ab.c Éa_b " * 50
    whole = [t for some in nra.terms(text) for t in some]
    assert [t.decode() for t in whole] == plain_terms(text)
    monkeypatch.setattr(nra, "CHUNK", 7)
    assert [t for some in nra.terms(text) for t in some] == whole


def test_lists_that_cannot_reach_the_best_are_not_read():
    rng = np.random.default_rng(8)
    n, lists = 5000, 12
    places = [np.sort(rng.choice(n, rng.integers(5, 3000), replace=False)) for _ in range(lists)]
    impacts = [np.sort(rng.integers(1, 10 ** rng.integers(2, 5), len(p)))[::-1] for p in places]
    block = nra.Block(
        np.arange(lists), np.array([len(p) for p in places]), np.concatenate(places), np.concatenate(impacts), pa.array(np.arange(n))
    )
    exact = np.zeros(n, np.int64)
    for p, x in zip(places, impacts, strict=True):
        exact[p] += x
    for k in (1, 10, 4999):
        place, score = block.search(np.arange(lists), k, 0)
        best = np.sort(exact)[-k]
        assert sorted(place.tolist()) == np.flatnonzero(exact >= max(best, 1)).tolist() and (score == exact[place]).all()
    top = int(exact.max())
    assert not len(block.search(np.arange(lists), 10, int(sum(x[0] for x in impacts)) + 1)[0])
    assert block.search(np.arange(lists), 10, top)[0].tolist() == np.flatnonzero(exact == top).tolist()
