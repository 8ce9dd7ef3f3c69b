"""SimHash, line dedup, mixing, nearest neighbours, WARC and the pipeline against brute force."""

import re
import uuid
from collections import defaultdict
from hashlib import md5, sha256
from itertools import combinations
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from haulbook.llm import forest, linededup, mixing, simhash, warc
from haulbook.llm.common import new_folder, shared_folder, ship
from haulbook.llm.components import components
from haulbook.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture
def shipped(spark):
    ship(spark)
    return spark


def documents(spark, texts, **extra):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


def groups(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- components and SimHash


def test_components_of_paths_stars_and_loops(shipped):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 150)] + [(7, 7), (201, 200), (200, 201)]
    df = shipped.createDataFrame([*links, (None, 3)], "a long, b long")
    nodes = {x for link in links for x in link}
    assert {r.node: r.root for r in components(df).collect()} == groups(links, nodes)
    assert components(df.filter("false")).count() == 0


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_of_odd_texts():
    for text in [None, "", " \n", "One", "One TWO", "a b c", "É é\x0bÀ x y z", "A a " * 50, "x y z " * 30_000]:
        assert simhash.text_fingerprint(text) == plain_fingerprint(text)


def test_pivot_tables_lose_no_link(shipped):
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 64, 60, dtype=np.uint64)
    fps = list(seeds)
    for s in seeds:
        for flips in (1, 2, 3, 3, 4, 5):
            fps.append(s ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, flips, replace=False))))
    fps += [seeds[0] ^ np.uint64(1 << a | 1 << b) for a, b in combinations(range(30), 2)]  # a large block
    bits = np.unique(np.array(fps, np.uint64))
    signed = bits.view(np.int64).tolist()
    near = np.bitwise_count(bits[:, None] ^ bits[None]) <= 3
    expected = groups(((signed[i], signed[j]) for i, j in zip(*np.nonzero(near))), signed)
    found = simhash.fingerprint_links(shipped.createDataFrame([(s,) for s in signed], "fp long")).collect()
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 3 for a, b in found)
    assert groups(found, signed) == expected


def test_large_blocks_are_split_and_lose_no_link(shipped, monkeypatch):
    """A third of all fingerprints, all distinct, are within a few bits of one: no task compares more than a bounded block."""
    rng = np.random.default_rng(9)
    center = np.uint64(0x0123456789ABCDEF)
    flip = lambda n: np.uint64(sum(1 << int(b) for b in rng.choice(64, n, replace=False)))
    near = {int(center ^ flip(n)) for n in rng.choice([1, 2, 3, 4, 6, 8], 1200)}
    far = {int(x) for x in rng.integers(0, 1 << 64, 2400, dtype=np.uint64)}
    bits = np.array(sorted(near | far), np.uint64)
    signed = bits.view(np.int64).tolist()
    close = np.bitwise_count(bits[:, None] ^ bits[None]) <= 3
    expected = groups(((signed[i], signed[j]) for i, j in zip(*np.nonzero(close))), signed)
    whole = simhash.PivotTable().keys(bits)
    assert max(np.unique(whole[:, j], return_counts=True)[1].max() for j in range(whole.shape[1])) > 100

    links = simhash._block_links

    def counted(max_bits):
        run, out = links(max_bits), str(folder)

        def outer(frames):
            def noted():
                for frame in frames:
                    sizes = frame.groupby("key").size()
                    with open(f"{out}/{uuid.uuid4().hex}", "w") as f:
                        f.write(str(int(sizes.max()) if len(sizes) else 0))
                    yield frame

            yield from run(noted())

        return outer

    folder = Path(new_folder(shipped, "seen").removeprefix("file:"))
    folder.mkdir(parents=True)
    monkeypatch.setattr(simhash, "_block_links", counted)
    df = shipped.createDataFrame([(s,) for s in signed], "fp long")
    found = simhash.fingerprint_links(df, block_rows=30).collect()
    seen = [int(f.read_text()) for f in folder.iterdir()]
    assert seen and max(seen) <= 30
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 3 for a, b in found)
    assert groups(found, signed) == expected


def test_simhash_groups_of_the_sample(shipped, small):
    rows = QUERIES["op10_simhash"](shipped, small).collect()
    bits = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    links = [(a, b) for a, b in combinations(sorted(bits), 2) if (bits[a] ^ bits[b]).bit_count() <= 3]
    assert {r.doc_id: r.component_id for r in rows} == groups(links, bits)
    for r in shipped.read.parquet(f"{small}/documents.parquet").limit(40).collect():
        assert bits[r.doc_id] == plain_fingerprint(r.text)


def test_groups_of_rows_without_ids(shipped):
    """A null id stays null; it names a group only if the group has no other."""
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(None, text), (7, text), (9, text + " end"), (None, "alone here"), (None, None), (3, ""), (3, "")]
    df = shipped.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("clash"))
    found = sorted(((r.doc_id, r.component_id) for r in simhash.simhash_groups(df).collect()), key=repr)
    assert found == sorted([(None, 7), (7, 7), (9, 7), (None, None), (None, 3), (3, 3), (3, 3)], key=repr)
    assert simhash.simhash_groups(df.filter("false")).count() == 0


def test_near_duplicates_keep_one_row_of_each_group(shipped):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(5, text), (3, text), (3, text), (4, text + " end"), (None, text), (None, "other words here"), (9, None), (8, "")]
    df = shipped.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit(1), "_fp": F.lit(2)})
    kept = simhash.without_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == ["3", "8", "None"]
    assert simhash.without_near_duplicates(df.filter("false")).count() == 0


# --- line dedup


def test_patience_aligns_in_order():
    pairs = linededup.patience([1, 2, 3, 9, 4, 5], [0, 1, 2, 3, 4, 7, 5])
    assert pairs == [(0, 1), (1, 2), (2, 3), (4, 4), (5, 6)]
    assert linededup.patience([1, 2, 3], [3, 2, 1]) and linededup.patience([], [1]) == []
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 12, 15).tolist(), rng.integers(0, 12, 15).tolist()
        found = linededup.patience(a, b)
        assert all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))


def line(name, words=12):
    return " ".join(f"{name}{i}" for i in range(words))


def test_passages_go_from_later_documents_only(shipped):
    passage, often = [line("p"), line("q"), "", line("r")], line("often", 60)
    texts = [
        "\n".join([line("a"), *passage, line("b")]),
        "\n".join([line("c"), *passage, line("d")]),
        "\n".join([line("e"), "short line", line("p")]),  # one line of 12 words is too short a block
        None, "", "short line\nshort line",
    ]
    texts += [f"{line(f'own{i}_')}\n{often}" for i in range(30)] + ["\n".join(passage)]
    df = documents(shipped, texts, lines="clash", _lines="clash", n_lines=7, n_chars=-1)
    rows = {r.doc_id: r for r in linededup.without_repeated_lines(df, n_chars="n_chars").collect()}
    assert rows[0].text == texts[0] and rows[1].text == f"{line('c')}\n{line('d')}"
    assert [rows[i].text for i in (2, 3, 4, 5)] == texts[2:6] and rows[6].text == texts[6]
    assert all(rows[i].text == line(f"own{i - 6}_") for i in range(7, 36)) and rows[36].text == ""
    assert rows[1].n_chars == len(rows[1].text) and rows[3].n_chars is None and rows[1].n_lines == 7
    assert linededup.without_repeated_lines(df.filter("false")).count() == 0


def test_repeated_rows_and_null_ids_stay(shipped):
    text = "\n".join(line(x) for x in "abc")
    other = "\n".join(line(x) for x in "xyz")
    rows = [(1, text), (1, text), (None, text), (2, text), (2, other)]
    df = shipped.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(r.doc_id), r.text) for r in linededup.without_repeated_lines(df).collect())
    assert found == [("1", text), ("1", text), ("2", ""), ("2", other), ("None", text)]


def plain_passages(texts, min_words):
    """Of each text the lines in runs of at least so many words that an earlier text has in one piece, blank lines aside."""
    split = [[x.strip(" \t\x0b\x0c\r") for x in (t or "").split("\n")] for t in texts]
    full = [[i for i, x in enumerate(lines) if x] for lines in split]
    out = []
    for d, lines in enumerate(split):
        mine, gone = [lines[i] for i in full[d]], set()
        for e in range(d):
            other = [split[e][i] for i in full[e]]
            for i in range(len(mine)):
                for j in range(len(other)):
                    n = 0
                    while i + n < len(mine) and j + n < len(other) and mine[i + n] == other[j + n]:
                        n += 1
                    if sum(len(x.split()) for x in mine[i : i + n]) >= min_words:
                        gone |= set(range(i, i + n))
        drop = set()
        for k, i in enumerate(full[d]):
            if k in gone:
                drop.add(i)
                if k - 1 in gone:
                    drop |= set(range(full[d][k - 1], i))
        pieces = (texts[d] or "").split("\n")
        out.append("\n".join(x for i, x in enumerate(pieces) if i not in drop) if drop else texts[d])
    return out


@pytest.mark.parametrize(("rare", "kinds", "count"), [(8, 40, 60), (2, 12, 60), (3, 200, 90)])
def test_deleted_blocks_equal_brute_force(shipped, rare, kinds, count):
    rng = np.random.default_rng(rare)
    chance = 1 / np.arange(1, kinds + 1)
    pool = [" ".join(f"w{x}_{i}" for i in range(1 + x % 9)) for x in range(kinds)]
    texts = [[pool[x] for x in rng.choice(kinds, rng.integers(0, 14), p=chance / chance.sum())] for _ in range(count)]
    for t in texts[10:]:  # passages of earlier texts, some in another order, and blank lines
        for _ in range(rng.integers(0, 3)):
            other = texts[rng.integers(0, 10)]
            at = rng.integers(0, len(other) + 1)
            spot = rng.integers(0, len(t) + 1)
            t[spot:spot] = [*other[at : at + 5], *[""] * rng.integers(0, 2)]
    texts = ["\n".join(t) for t in texts] + ["", None, "\n \n"]
    rows = {r.doc_id: r.text for r in linededup.without_repeated_lines(documents(shipped, texts), rare=rare, min_words=12).collect()}
    assert [rows[i] for i in range(len(texts))] == plain_passages(texts, 12)


@pytest.mark.parametrize("more", [0, 30])
def test_result_does_not_depend_on_the_number_of_sharers(shipped, more):
    """A, B, A X B, A B: no passage of 24 words is in one piece in an earlier document, however many have its lines."""
    a, b = line("a"), line("b")
    texts = [a, b, f"{a}\n{line('x')}\n{b}", f"{a}\n{b}", f"own line\n{a}\n\n{b}"]
    texts = [*texts[:2], *[f"{line(f'o{i}_')}\n{(a, b)[i % 2]}" for i in range(more)], *texts[2:]]
    rows = {r.doc_id: r.text for r in linededup.without_repeated_lines(documents(shipped, texts)).collect()}
    assert [rows[len(texts) - i] for i in (3, 2, 1)] == [texts[-3], texts[-2], "own line"]


def test_pairs_against_brute_force(shipped):
    rng = np.random.default_rng(4)
    texts = ["\n".join(f"line {x}" for x in rng.integers(0, 60, 8)) for _ in range(40)]
    found = {tuple(r) for r in linededup.paired(documents(shipped, texts), rare=3, min_words=4).collect()}
    holders, runs = defaultdict(set), defaultdict(list)
    for i, text in enumerate(texts):
        for x in text.split("\n"):
            holders[x].add(i)
    expected = {(b, a) for docs in holders.values() if len(docs) <= 3 for a, b in combinations(sorted(docs), 2)}
    for i, text in enumerate(texts):
        lines = text.split("\n")
        for two in zip(lines, lines[1:]):
            if all(len(holders[x]) > 3 for x in two):
                runs[two].append(i)
    expected |= {(d, docs[0]) for docs in runs.values() for d in docs if d > docs[0]}
    assert found == expected


def test_passages_that_the_first_holder_has_in_another_order(shipped):
    a, b = [line("a1"), line("a2")], [line("b1"), line("b2")]
    texts = ["\n".join([*b, *a])] + ["\n".join([line(f"own{i}_"), *a, *b]) for i in range(30)]
    texts += ["\n".join([line("y"), line("x")])] + ["\n".join([line(f"z{i}_"), line("x"), "", line("y")]) for i in range(20)]
    rows = {r.doc_id: r.text for r in linededup.without_repeated_lines(documents(shipped, texts)).collect()}
    assert rows[0] == texts[0] and all(rows[i] == line(f"own{i - 1}_") for i in range(1, 31))
    assert rows[31] == texts[31] and rows[32] == texts[32]  # the first that has them in this order
    assert all(rows[i] == line(f"z{i - 32}_") for i in range(33, 52))


def test_short_lines_from_different_documents_stay(shipped):
    shorts = [line(f"s{i}_", 6) for i in range(5)]
    texts = [f"{line(f'own{i}_')}\n{s}" for i, s in enumerate(shorts)] + ["\n".join(shorts), "\n".join(shorts[1:])]
    rows = {r.doc_id: r.text for r in linededup.without_repeated_lines(documents(shipped, texts)).collect()}
    assert [rows[i] for i in range(7)] == [*texts[:6], ""]


# --- mixing


def test_targets_stop_at_three_times_the_size():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    assert mixing.targets([10, 500, 490], [5, 2, 1]) == [30.0, 970 * 2 / 3, 970 / 3]
    assert mixing.targets([0, 0], [5, 2]) == [0, 0] and mixing.targets([], []) == []


def test_flow_is_cheapest_and_fills_quotas():
    capacity = {("a",): 100, ("a", "b"): 100, ("b",): 50}
    taken = mixing.flow(capacity, {"a": 120, "b": 100})
    assert sum(taken.values()) == 220 and all(taken[p] <= capacity[p] for p in capacity)  # first copies are enough
    taken = mixing.flow(capacity, {"a": 150, "b": 150})
    assert sum(taken.values()) == 300 and all(capacity[p] <= taken[p] <= 2 * capacity[p] for p in capacity)
    taken = mixing.flow({("a",): 10, ("a", "b"): 10}, {"a": 1000, "b": 15})
    assert taken[("a",)] == 30 and taken[("a", "b")] == 30  # no more than three copies
    assert mixing.flow({(): 5}, {"a": 3}) == {(): 0} and mixing.flow({}, {}) == {}


def test_flow_cost_against_brute_force():
    def cost(pattern_words, taken):
        whole, rest = divmod(taken, pattern_words)
        return sum((2 * r + 1) * pattern_words for r in range(whole)) + (2 * whole + 1) * rest

    capacity, quota = {("a",): 2, ("a", "b"): 3, ("b",): 1}, {"a": 5, "b": 4}
    best = None
    for x in range(7):
        for y in range(10):
            for z in range(4):
                if x <= 5 and z <= 4 and x + z + y == 9 and 5 - x + 4 - z == y:
                    price = cost(2, x) + cost(3, y) + cost(1, z)
                    best = price if best is None else min(best, price)
    found = mixing.flow(capacity, quota)
    assert sum(found.values()) == 9
    assert cost(2, found[("a",)]) + cost(3, found[("a", "b")]) + cost(1, found[("b",)]) == best


def test_mix_comes_near_the_targets(shipped, small):
    rows = QUERIES["op9_mixing"](shipped, small).collect()
    again = QUERIES["op9_mixing"](shipped, small).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    docs = {r.doc_id: r for r in shipped.read.parquet(f"{small}/documents.parquet").collect()}
    sizes, taken, target, largest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        size = len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        source = docs[r.doc_id].source
        assert r.size == size and r.taken % max(1, size) == 0 and r.taken <= 3 * size
        sizes[source] += size
        taken[source] += r.taken
        target[source], largest[source] = r.target, max(largest[source], size)
    order = sorted(sizes)
    wanted = mixing.targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))])
    for source, t in zip(order, wanted):
        assert abs(target[source] - t) < 1e-6 and abs(taken[source] - t) <= largest[source]


def test_mix_of_overlapping_sources(shipped):
    rows = [(i, 10, ["a"] if i % 3 == 0 else ["a", "b"] if i % 3 == 1 else ["b", None]) for i in range(300)]
    df = shipped.createDataFrame([*rows, (999, 0, ["a"])], "doc_id long, size long, pattern array<string>")
    mixed = mixing.mix(df, {"a": 1500, "b": 700, None: 400})
    words = sum(r["size"] * r.copies for r in mixed.collect())
    assert abs(words - 2600) <= 20 and mixed.filter("doc_id = 999").first().copies == 0
    assert mixed.agg(F.max("copies")).first()[0] == 1  # nothing twice while first copies are left


def test_mix_fills_the_rest_beside_long_documents(shipped):
    rows = [(i, 100, ["a"]) for i in range(1000)] + [(5000 + i, 100_000, ["a"]) for i in range(3)]
    rows += [(10_000 + i, 1 + i * i % 977, ["b"]) for i in range(600)] + [(20_000 + i, 40_000 + i, ["b"]) for i in range(5)]
    df = shipped.createDataFrame(rows, "doc_id long, size long, pattern array<string>")
    wanted = {"a": 60_000, "b": 130_001}
    mixed = mixing.mix(df, wanted).collect()
    for source in "ab":
        mine = [r for r in mixed if r.pattern == [source]]
        rest = [r["size"] for r in mine if not r.copies]
        assert abs(wanted[source] - sum(r["size"] * r.copies for r in mine)) < min(rest)
        assert all(r.copies <= 1 for r in mine)
    assert sum(r["size"] * r.copies for r in mixed if r.pattern == ["a"]) == 60_000


@pytest.mark.parametrize("wanted", [1, 777, 20_011, 39_000])
def test_mix_selects_in_the_order_of_the_hash(shipped, wanted):
    """Every document that fits in what is left by then, and at last one that overshoots if that comes nearer."""
    rng = np.random.default_rng(wanted)
    sizes = [int(x) for x in rng.integers(1, 60, 900)] + [5000, 9000, 4000]
    rows = [(i, n, ["s"]) for i, n in enumerate(sizes)]
    df = shipped.createDataFrame(rows, "doc_id long, size long, pattern array<string>")
    found = {r.doc_id for r in mixing.mix(df, {"s": wanted}).collect() if r.copies}
    order = sorted(range(len(sizes)), key=lambda i: md5(f"{mixing.SEED}/{i}".encode()).hexdigest()[: mixing.HASH_BITS // 4])
    left, taken = wanted, set()
    for i in order:
        if sizes[i] <= left:
            taken.add(i)
            left -= sizes[i]
    over = [(abs(sizes[i] - left), n, i) for n, i in enumerate(order) if i not in taken and abs(sizes[i] - left) < left]
    assert found == taken | ({min(over)[2]} if over else set())


def test_mix_odd_rows(shipped):
    rows = [(1, None, "s"), (2, "", None), (3, "a b", None), (3, "a b", None), (None, "c", "s"), (4, "   x", "")]
    df = shipped.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit("clash"))
    found = mixing.mix_sources(df).collect()
    assert len(found) == 6 and sorted(r["size"] for r in found) == [0, 0, 1, 2, 2, 2]
    kept = mixing.repeated(df)
    assert kept.columns == df.columns and kept.filter("text is null or text = ''").count() == 0
    assert mixing.mix_sources(df.filter("false")).count() == 0 and mixing.repeated(df.filter("false")).count() == 0


# --- nearest neighbours


def test_nearest_recall_and_scores(shipped, small):
    rows = QUERIES["op3_hash_forest"](shipped, small).collect()
    known = shipped.read.parquet(f"{small}/embeddings.parquet").orderBy("vec_id").collect()
    ids = np.array([r.vec_id for r in known])
    x = np.array([r.embedding for r in known], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = defaultdict(dict)
    for r in rows:
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    hits = 0
    for i in np.flatnonzero(ids % 50 == 0):
        cosines = x @ x[i]
        cosines[i] = -9
        best = set(ids[np.lexsort((ids, -cosines))[:5]].tolist())
        got = found.pop(int(ids[i]))
        assert sorted(got) == [1, 2, 3, 4, 5]
        assert all(abs(cosines[np.flatnonzero(ids == v)[0]] - s) < 1e-12 for v, s in got.values())
        hits += len(best & {v for v, _ in got.values()})
    assert not found and hits / (5 * (ids % 50 == 0).sum()) >= 0.9


def test_nearest_with_many_blocks(shipped):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 16))
    df = shipped.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = forest.nearest(df, F.col("id") % 50 == 0, block_rows=400).collect()
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 1500, 50):
        cosines = x @ x[q]
        cosines[q] = -9
        hits += len(set(np.argsort(-cosines)[:5].tolist()) & {r.vec_id for r in rows if r.query_id == q})
    assert hits / 150 >= 0.9


@pytest.mark.parametrize("spread", [0.1, 0.003, 1e-5])
def test_nearest_where_a_third_are_near_copies(shipped, spread):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(6000, 32))
    x[::3] = x[0] + spread * rng.normal(size=(2000, 32))
    df = shipped.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = defaultdict(set)
    for r in forest.nearest(df, F.col("id") % 60 == 0).collect():
        found[r.query_id].add(r.vec_id)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 6000, 60):
        far = ((x - x[q]) ** 2).sum(1)
        far[q] = 9
        hits += len(found[q] & set(np.argsort(far, kind="stable")[:5].tolist()))
    assert forest.candidates(6000) < 1000 and hits >= 0.9 * 500


def test_nearest_of_copies_and_unusable_vectors(shipped):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(20)] + [(50, [0.0, 1.0]), (51, None), (52, []), (53, [0.0, 0.0])]
    rows += [(54, [nan, 1.0]), (55, [inf, 1.0]), (56, [None, 1.0]), (57, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (100, [1.0, 1.0])]
    rows += [(100, [1.0, 1.0]), (150, [2.0, 0.0])]
    df = shipped.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit("clash"))
    found = defaultdict(list)
    for r in forest.nearest(df, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, round(r.score, 9)))
    assert found[0] == [(i, 1.0) for i in (1, 2, 3, 4, 5)] and found[150] == [(i, 1.0) for i in range(5)]
    half = round(0.5**0.5, 9)
    assert found[100] == [(i, half) for i in range(5)] and found[50][0] == (100, half) and len(found[50]) == 5
    few = shipped.createDataFrame([(0, [1.0]), (1, [-1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in forest.nearest(few, F.col("id") == 0).collect()] == [(0, 1, 1, -1.0)]
    assert forest.nearest(few.filter("false"), F.lit(True)).count() == 0


def test_nearest_of_extreme_vectors(shipped):
    """Scaling by a power of two keeps norms from overflowing and changes no digit of an ordinary score."""
    rows = [(0, [1e200, 1e200]), (1, [2.0**660, 0.0]), (2, [-1e308, -1e308]), (3, [5e-324, 5e-324]), (4, [3e-310, 4e-310]), (5, [0.3, 0.1])]
    df = shipped.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {(r.query_id, r.vec_id): r.score for r in forest.nearest(df, F.lit(True)).collect()}
    assert len(found) == 30
    want = {(0, 1): 0.5**0.5, (0, 2): -1.0, (0, 3): 1.0, (4, 1): 0.6, (3, 4): 1.4 / 2**0.5}
    assert all(abs(found[k] - v) < 1e-12 for k, v in want.items())
    x, y = np.array([0.3, 0.1]), np.array([1.0, 0.0])
    assert found[5, 1] == (x * y).sum() / (np.sqrt((x * x).sum()) * 1.0)


def test_nearest_visits_blocks_of_a_table_of_any_size(shipped):
    """No switch by size: with a small share the same descent serves a table of many blocks and parts, whole or in pieces."""
    rng = np.random.default_rng(14)
    x = rng.normal(size=(4000, 24)) + 2 * rng.normal(size=(40, 24))[rng.integers(0, 40, 4000)]
    df = shipped.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for block_rows in (300, 10_000):
        rows = forest.nearest(df, F.col("id") % 50 == 0, block_rows=block_rows, per_query=1200).collect()
        hits = 0
        for q in range(0, 4000, 50):
            cosines = x @ x[q]
            cosines[q] = -9
            hits += len(set(np.argsort(-cosines)[:5].tolist()) & {r.vec_id for r in rows if r.query_id == q})
        assert hits / 400 >= 0.9


# --- WARC


def test_warc_round_trip_of_odd_pages(shipped):
    page = "<p>é</p>" * 40
    rows = [(7, "http://a/", page), (3, "http://b/ c\r\nX: y", page), (9, None, page), (1, "u", None), (2, "u", ""), (4, "u", "x"),
            (5, "u", "x"), (None, "u", "null id"), (6, "u", "\r\n\r\nWARC/1.1\r\n\x00\x1f\u008b\x08")]
    df = shipped.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    found = {r.page_id: r for r in warc.round_trip(shipped, df).collect()}
    assert len(found) == len(rows) and all(r.valid for r in found.values())
    for page_id, _, html in rows:
        data = (html or "").encode()
        r = found[page_id]
        assert r.payload_bytes == len(data) and r.payload_digest == sha256(data).hexdigest()
        revisit = page_id in (7, 9)
        assert (r.record_type, r.refers_to) == (("revisit", 3) if revisit else ("response", None))
    assert warc.round_trip(shipped, df.filter("false")).count() == 0


def test_warc_query_equals_sql(shipped, small):
    sql = duckdb.connect()
    sql.execute(f"create view pages as select * from '{small}/pages.parquet'")
    columns = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    expected = sql.sql(f"select {columns} from ({ORACLE_SQL['op1_warc']})").fetchall()
    found = QUERIES["op1_warc"](shipped, small).select(*columns.split(", ")).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def archive(tmp_path, name, chunks):
    folder = tmp_path / "archive"
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(b"".join(chunks))
    return str(folder)


def with_magic(number):
    """Bytes that gzip stores as they are, with the magic in them."""
    noise = np.random.default_rng(number).bytes(3000)
    return noise[:1000] + warc.MAGIC + noise[1000:2000] + warc.MAGIC + b"\x00" + noise[2000:]


def test_reader_splits_anywhere(shipped, tmp_path, monkeypatch):
    """Small byte ranges, members with the magic inside, larger than a range, and a name that Hadoop would inflate."""
    monkeypatch.setattr(warc, "LEVEL", 0)
    payloads = [with_magic(i) for i in range(20)] + [b"tiny", b"", b"z" * 200_000]
    records = [warc.record(str(i), p, sha256(p).hexdigest()) for i, p in enumerate(payloads)]
    assert sum(r.count(warc.MAGIC) for r in records) > 60
    path = archive(tmp_path, "a.warc.gz", records)
    archive(tmp_path, "b.warc.gz", [warc.record("b", b"other file", sha256(b"other file").hexdigest())])
    for size in ("700", "1024", "5000", "134217728"):
        shipped.conf.set("spark.sql.files.maxPartitionBytes", size)
        shipped.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            found = {r.record_id.removeprefix(warc.URN): r for r in warc.read_warc(shipped, path).collect()}
        finally:
            shipped.conf.unset("spark.sql.files.maxPartitionBytes")
            shipped.conf.unset("spark.sql.files.openCostInBytes")
        assert len(found) == len(payloads) + 1 and all(r.valid for r in found.values())
        assert all(bytes(found[str(i)].payload) == p for i, p in enumerate(payloads))


def test_reader_reports_broken_members(shipped, tmp_path):
    good = warc.record("1", b"good", sha256(b"good").hexdigest())
    wrong = warc.record("2", b"payload", "0" * 64)
    path = archive(tmp_path, "c", [good, wrong, warc._gzip(b"no record, but longer than a header " * 4), good[:-20]])
    rows = warc.read_warc(shipped, path).collect()
    assert [r.valid for r in rows].count(True) == 1 and len(rows) == 4
    assert {r.problem for r in rows} >= {"payload digest differs"}


@pytest.mark.parametrize("level", [0, 6])
def test_reader_goes_on_behind_a_damaged_member(shipped, tmp_path, monkeypatch, level):
    """A member in the middle of a file is cut at ten places: every other record comes back, and one broken row."""
    monkeypatch.setattr(warc, "LEVEL", level)
    rng = np.random.default_rng(level)
    letters = np.array(list("abcdefgh \n"))
    texts = ["".join(rng.choice(letters, 2500)).encode() for _ in range(9)]
    records = [warc.record(str(i), t, sha256(t).hexdigest()) for i, t in enumerate(texts)]
    cuts = np.linspace(12, len(records[4]) - 6, 10).astype(int).tolist()
    files = [[*records[:4], records[4][:cut], *records[5:]] for cut in cuts]
    files.append([*records[:3], records[3][:500], records[4][:700], *records[5:]])  # two in a row
    for f in files:
        for size in (300, 1500, 1 << 20):
            data, ranges = b"".join(f), {}
            # as Spark's text source deals them: a piece belongs to the range in which its separator begins
            starts = [m.start() for m in re.finditer(re.escape(warc.MAGIC), data)]
            for a, b in zip(starts, [*starts[1:], len(data)], strict=True):
                ranges.setdefault(a // size, []).append(data[a:b])
            found, fragments = [], []
            for pieces in ranges.values():
                for kind, value in warc.members(iter(pieces), False):
                    (found if kind == "record" else fragments).append(value)
            joined = [warc.MAGIC + x for x in b"".join(fragments).split(warc.MAGIC)[1:]]
            found += [v for _, v in warc.members(iter(joined), True)]
            good = sorted(int(v[0].removeprefix(warc.URN)) for v in found if v[7])
            lost = {3, 4} if len(f) == 9 and f[3] != records[3] else {4}
            assert good == [i for i in range(9) if i not in lost]
            assert sum(not v[7] for v in found) == len(lost)
    path = archive(tmp_path, "cut.warc.gz", files[5])
    for size in ("700", "134217728"):
        shipped.conf.set("spark.sql.files.maxPartitionBytes", size)
        shipped.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            rows = warc.read_warc(shipped, path).collect()
        finally:
            shipped.conf.unset("spark.sql.files.maxPartitionBytes")
            shipped.conf.unset("spark.sql.files.openCostInBytes")
        assert sorted(r.record_id[-1] for r in rows if r.valid) == list("01235678") and len(rows) == 9


def test_large_member_ends_with_zero():
    data = np.random.default_rng(1).bytes(17 << 20)
    member = warc.record("1", data, sha256(data).hexdigest())
    assert member[-1] == 0


# --- the pipeline


def test_pipeline_stages_one_after_another(shipped, small):
    docs = shipped.read.parquet(f"{small}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    language = corpus_pipeline.language(shipped, docs, small)
    assert language.columns == docs.columns and language.count() == len(before)
    cut = corpus_pipeline.lines(shipped, language, small)
    assert cut.columns == docs.columns and all(r.n_chars == len(r.text) for r in cut.collect())
    one = corpus_pipeline.near_duplicates(shipped, cut, small)
    bits = {r.doc_id: plain_fingerprint(r.text) for r in cut.collect()}
    links = [(a, b) for a, b in combinations(sorted(bits), 2) if (bits[a] ^ bits[b]).bit_count() <= 3]
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(groups(links, bits).values()))
    mixed = corpus_pipeline.mix(shipped, one, small)
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(one).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == copies
    rows = corpus_pipeline.run(shipped, small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(d for d, n in copies.items() for _ in range(n))
    assert all(r.n_tokens == len(r.token_ids) for r in rows)


def test_last_stage_decodes_what_it_encodes(shipped):
    texts = ["The house, 日本語 😀", "", None, "a  b\n\n c" * 300]
    rows = corpus_pipeline.tokens(shipped, documents(shipped, texts, source="s"), "").collect()
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {i: sha256((x or "").encode()).hexdigest() for i, x in enumerate(texts)}


def test_stages_keep_further_columns(shipped, small):
    docs = shipped.read.parquet(f"{small}/documents.parquet").limit(60)
    more = docs.withColumns({"score": F.lit("kept"), "lang_pred": F.col("doc_id"), "_fp": F.lit(1.5)})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(shipped, more, small)
        assert out.dtypes == more.dtypes
        rows = out.collect()
        assert rows and all((r["score"], r["lang_pred"], r["_fp"]) == ("kept", r["doc_id"], 1.5) for r in rows)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"
        getConf = staticmethod(dict)
        getCheckpointDir = staticmethod(lambda: None)

    session = type("Session", (), {"sparkContext": Context()})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_pipeline_on_odd_tables(shipped):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, fp int"
    rows = [(None, None, None, None, None, "x", 1), (1, "", "en", "s", 0, "x", 1), (2, "the house", "en", None, 9, "x", 1),
            (2, "the house", "en", None, 9, "x", 1), (3, "123", "en", "s", 3, "x", 1)]
    for docs in (shipped.createDataFrame(rows, schema), shipped.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(shipped, docs, "")
            path = new_folder(shipped, name)
            docs.write.parquet(path)
            docs = shipped.read.parquet(path)
        assert {r.doc_id for r in docs.collect()} <= {2}
