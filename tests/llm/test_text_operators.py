"""Language ID, BPE, sketches, toxicity and LM scoring against brute force, round trips and held-out rows."""

import base64
import math
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from haulbook.llm import bpe, langid, lmscore, sketch, toxicity
from haulbook.llm.common import ship, word_chunks, written
from haulbook.llm.queries import QUERIES

ODD = [
    None, "", " ", "\n\n", "a", "don't  stop\n\n now", " 's 'S ''s x's", "a b c \x85 d\x1c e", "日本語のテキスト", "1２³ ٣٤",
    "tab\t\ttab \t x", "é é ß ẞ", "😀 😀😀", "  lead and trail  ", "x" * 700, "ab" * 600 + " " + "\x00 \x07", "aaaaaaaa aaa",
]


@pytest.fixture
def shipped(spark):
    ship(spark)
    return spark


def documents(spark, texts, **extra):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


def reference():
    lines = open(public_tokenizers.path(bpe.RANKS), "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library_on_odd_texts(shipped):
    known = reference()
    rows = bpe.with_tokens(documents(shipped, ODD, token_ids="clash", decoded="clash")).collect()
    assert {r.doc_id: r.token_ids for r in rows} == {i: known.encode_ordinary(t or "") for i, t in enumerate(ODD)}


def test_bpe_decodes_what_it_encodes(shipped):
    df = bpe.with_tokens(documents(shipped, ODD))
    rows = bpe.with_decoded(df.withColumn("decoded", F.lit(1))).orderBy("doc_id").collect()
    assert [bytes(r.decoded).decode() for r in rows] == [t or "" for t in ODD]
    nothing = df.select("doc_id", F.lit(None).cast("array<int>").alias("token_ids"))
    assert bytes(bpe.with_decoded(nothing).first().decoded) == b""


def test_bpe_round_trip_on_the_sample(shipped, small):
    known, texts = reference(), {}
    for r in shipped.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect():
        texts[r.doc_id] = r.text or ""
    rows = QUERIES["op5_byte_bpe"](shipped, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(known.encode_ordinary(texts[r.doc_id]), "<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_long_text_is_cut_where_words_end():
    codec, known = bpe.codec(bpe.rank_file(), public_tokenizers.PATTERN), reference()
    text = "Some words, a\n\nfew   more don't 12 " * 200_000
    offsets, ids = codec.encode(pa.array([text, None, "x"]))
    assert offsets.tolist() == [0, len(ids) - 1, len(ids) - 1, len(ids)]
    assert ids[:-1].tolist() == known.encode_ordinary(text)
    assert codec.decode(offsets, ids).to_pylist() == [text.encode(), b"", b"x"]


def test_bpe_decodes_any_ids_and_refuses_unknown_ones():
    codec = bpe.codec(bpe.rank_file(), public_tokenizers.PATTERN)
    ids = np.random.default_rng(1).integers(0, 50_256, 20_000)
    offsets = np.array([0, 0, 7, 7, 20_000, 20_000])
    expected = [reference().decode_bytes(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
    assert codec.decode(offsets, ids).to_pylist() == expected
    assert codec.decode(np.array([0, 0]), np.array([], int)).to_pylist() == [b""]
    with pytest.raises(ValueError):
        codec.decode(np.array([0, 1]), np.array([50_256]))


def test_language_of_held_out_documents(shipped, small):
    rows = QUERIES["op2_language"](shipped, small).collect()
    known = {r.doc_id: r for r in shipped.read.parquet(f"{small}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == known[r.doc_id].lang for r in held]) > 0.97
    assert len(rows) == len(known) and all(0 <= r.score <= 1 for r in rows)


def test_language_odd_texts(shipped):
    train = documents(shipped, ["the cat and the dog", "der Hund und die Katze"] * 3)
    train = train.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    profiles = langid.learn(train, F.lit(True))
    assert list(profiles) == ["de", "en"]
    texts = [None, "", "123 !?", "the dog", "die Katze", "the dog\n" * 300_000, "the dog"]
    rows = langid.with_language(documents(shipped, texts, lang_pred="clash", score="x"), profiles).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows] == ["und", "und", "und", "en", "de", "en", "en"]
    assert [r.score for r in rows[:3]] == [0, 0, 0] and rows[3].score == rows[6].score
    nothing = langid.learn(train.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert nothing == {} and langid.with_language(documents(shipped, ["a"]), nothing).first().lang_pred == "und"
    assert langid.with_language(documents(shipped, []), profiles).count() == 0


def test_language_bundle_is_the_sum_of_bound_grams():
    text, size = "Ab c", 64
    letters = {c: langid._letter(ord(c), size).astype(int) for c in "ab c"}
    whole = " ab c "
    expected = sum(
        np.roll(letters[x], 2) * np.roll(letters[y], 1) * letters[z] for x, y, z in zip(whole, whole[1:], whole[2:])
    )
    assert (langid.encode([text], 3, size)[0] == expected).all()


def test_sketch_estimates_and_merges():
    words = [f"w{i}" for i in range(3000)]
    a, b = sketch.sketch(" ".join(words)), sketch.sketch(" ".join(words[1000:]))
    assert abs(sketch.resemblance(a, b) - 2 / 3) < 0.15
    assert abs(sketch.containment(b, a) - 1) < 0.05 and abs(sketch.containment(a, b) - 2 / 3) < 0.15
    assert abs(sketch.distinct_shingles(a) / 2996 - 1) < 0.3
    parts = [sketch.sketch(" ".join(words[:1504])), sketch.sketch(" ".join(words[1500:]))]
    assert (sketch.merge(*parts) == a).all()
    empty = sketch.sketch(None)
    assert len(empty) == 0 and sketch.resemblance(empty, empty) == 1 and sketch.resemblance(empty, a) == 0
    assert len(sketch.sketch("two words")) == 1 and (sketch.from_text(sketch.to_text(a)) == a).all()


def test_merged_sketches_of_groups(shipped):
    texts = ["a b c d e f", "f g h i j k", "a b c d e f", None]
    df = sketch.with_sketch(documents(shipped, texts, part="p", fingerprint="clash"))
    merged = sketch.merged_sketches(df, ["part"]).first().fingerprint
    assert merged == sketch.to_text(sketch.merge(*map(sketch.sketch, texts)))


def test_sketch_report_against_brute_force(shipped, rows):
    texts = ["", None, "a b c d e f g h " * 9, "x", "ä ö ü 😀 " * 50, "same text here now ok", "same text here now ok"]
    texts += [f"text number {i} " * i for i in range(60)]
    df = documents(shipped, texts, fingerprint="clash", bucket=1)
    order = [t or "" for t in texts[::-1]]
    expected = []
    for i, text in enumerate(order):
        following = order[(i + 1) % len(order)]
        new = sketch.edited(text, following)
        fps = [sketch.sketch(t) for t in (text, new, following)]
        expected.append(
            (
                len(order) - 1 - i, len(text), sha256(new.encode()).hexdigest(), sketch.to_text(fps[0]),
                sketch.to_text(fps[1]), sketch.resemblance(fps[0], fps[1]), sketch.resemblance(fps[0], fps[2]),
            )
        )
    assert rows(sketch.edit_report(df)) == sorted(expected, key=repr)
    alone = sketch.edit_report(documents(shipped, ["only one document here today"])).first()
    assert alone.near_next == 1.0 and sketch.edit_report(documents(shipped, [])).count() == 0


def test_sketch_report_with_null_and_repeated_ids(shipped):
    df = shipped.createDataFrame([(None, "n"), (None, "m"), (3, "x y"), (3, "x y"), (1, "z")], "doc_id long, text string")
    found = sketch.edit_report(df).collect()
    assert sorted(str(r.doc_id) for r in found) == ["1", "3", "3", "None", "None"]


def toxic_sample(spark, count=400):
    """Mentions of women are more often toxic, but the insult alone decides."""
    rng, rows = np.random.default_rng(3), []
    for i in range(count):
        toxic = i % 2
        who = "women" if rng.random() < (0.95 if toxic else 0.05) else "men"
        filler = " ".join(rng.choice(["the", "of", "house", "tree", "walks", "over", "water"], 8))
        insult = rng.choice(["idiots", "scum"] if toxic and rng.random() < 0.7 else ["here", "there", "away"])
        rows.append((i, f"{filler}. All {who} are {insult}.", toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_counterfactuals_lower_the_score_of_neutral_mentions(shipped):
    docs, labels = toxic_sample(shipped)
    plain = toxicity.learn(docs, labels, F.lit(True), counterfactual=0.0)
    fair = toxicity.learn(docs, labels, F.lit(True))
    neutral = "All women are here."
    assert plain.score(neutral) > 0.5 > fair.score(neutral)
    assert abs(fair.score(neutral) - fair.score("All men are here.")) < 0.1
    assert fair.score("All men are scum.") > 0.5


def plain_toxicity(docs, labels, min_ratio, counterfactual, steps):
    """Scores of all docs by the definition: every feature of every row counted one by one, dense matrices, a plain loop."""
    def features(text):
        words = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
        return words | {w[:n] + "*" for w in words for n in (4, 5) if len(w) > n}

    rows = [(i, features(docs[i]), y) for i, y in sorted(labels.items())]
    n, n1 = len(rows), sum(y for _, _, y in rows)
    chosen = []
    for f in sorted({f for _, fs, _ in rows for f in fs}):
        a, b = (sum(f in fs for _, fs, y in rows if y == k) for k in (1, 0))
        part = lambda seen, of: seen * math.log(seen * n / ((a + b) * of)) if seen else 0.0  # noqa: B023, E731
        if a + b >= 3 and part(a, n1) + part(b, n - n1) >= min_ratio:
            chosen.append(f)
    vector = lambda fs: np.array([f in fs for f in chosen], float)
    x, y = np.array([vector(fs) for _, fs, _ in rows]), np.array([k for _, _, k in rows], float)
    pairs = []
    for i, _, _ in rows:
        seen = set()
        for sentence in re.findall(r"[^.!?\n]+", docs[i]):
            for other in toxicity.swapped(sentence):
                d = vector(features(sentence)) - vector(features(other))
                if d.any() and tuple(d) not in seen:
                    seen.add(tuple(d))
                    pairs.append(d)
    w, b, m, v = np.zeros(len(chosen)), 0.0, np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    share = np.where(y == 1, 0.5 / (n1 / n), 0.5 / (1 - n1 / n)) / n
    for t in range(1, steps + 1):
        error = share * (1 / (1 + np.exp(-(x @ w + b))) - y)
        grad = x.T @ error + toxicity.PENALTY * w / n
        for d in pairs:
            grad += 2 * counterfactual * (d @ w) * d / len(pairs)
        whole = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * whole, 0.999 * v + 0.001 * whole**2
        move = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - move[:-1], b - move[-1]
    return {i: 1 / (1 + np.exp(-(vector(features(t)) @ w + b))) for i, t in docs.items()}, chosen, pairs


def test_toxicity_against_brute_force(shipped):
    rng = np.random.default_rng(3)
    plain, bad = [f"calm{c}" for c in "abcdefgh"], ["vilest", "vileness", "scum"]
    docs, labels = {}, {}
    for i in range(160):
        toxic = i % 4 == 0
        words = rng.choice(plain, 6).tolist() + (rng.choice(bad, 2).tolist() if toxic else [])
        group = "women" if toxic and i % 8 == 0 else rng.choice(["men", "women", "gay", "people"])
        docs[i] = f"{' '.join(words[:4])}. The {group} {' '.join(words[4:])}!"
        if i < 120:
            labels[i] = int(toxic)
    docs[160], docs[161] = "", None
    left = shipped.createDataFrame(list(docs.items()), "doc_id long, text string")
    right = shipped.createDataFrame([*labels.items(), (130, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(left, right, F.lit(True), min_ratio=2.0)
    expected, chosen, pairs = plain_toxicity(docs, labels, 2.0, toxicity.COUNTERFACTUAL, toxicity.STEPS)
    assert sorted(model.weights) == chosen and {"vile*", "scum"} <= set(chosen) and pairs
    found = {r.doc_id: r for r in toxicity.with_toxicity(left, model).collect()}
    assert all(abs(found[i].score - expected[i]) < 1e-6 for i in docs)
    assert all(found[i].predicted == (found[i].score >= 0.5) for i in docs)
    assert sum(found[i].predicted == (i % 4 == 0) for i in range(120, 160)) >= 34


def test_swapping_terms():
    assert toxicity.swapped("no group") == []
    assert toxicity.swapped("Women and old men") == ["men and young women"]
    assert len(toxicity.swapped("a Muslim")) == 5


def test_toxicity_odd_inputs(shipped):
    docs, labels = toxic_sample(shipped, 100)
    odd = [(0, 1), (0, 0), (1, None), (None, 1), (7_000, 1), (2, 5)]
    labels = labels.unionByName(shipped.createDataFrame(odd, "doc_id long, toxic int"))
    model = toxicity.learn(docs, labels, F.lit(True))
    texts = [None, "", "scum", "scum " * 1_500_000, "scum"]
    rows = toxicity.with_toxicity(documents(shipped, texts, score="clash", predicted="x"), model).orderBy("doc_id").collect()
    assert rows[0].score == rows[1].score < rows[2].score and rows[2].score == rows[3].score == rows[4].score
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
    assert toxicity.with_toxicity(documents(shipped, []), model).count() == 0
    none = labels.filter("false")
    assert toxicity.learn(docs, none, F.lit(True)).score("scum") == 0.0
    assert toxicity.learn(docs, labels.filter("toxic = 1"), F.lit(True)).score("") == 1.0


def test_word_chunks_meet_every_window_once():
    text = "ab  Cd\te\n" * 40
    expected = text.encode().lower().split()
    for keep in (0, 2):
        chunks = list(word_chunks(text, keep, size=7))
        met = chunks[0] + [w for c in chunks[1:] for w in c[keep:]]
        assert met == expected
    assert list(word_chunks(None)) == [] and list(word_chunks("   ", size=1)) == []


def test_lm_score_against_brute_force(shipped):
    texts = ["a b a b", "a b c", None, "", "x y x y z", "A B", "a b a b"]
    df = documents(shipped, texts, score="clash", tokens=1)
    targets = shipped.createDataFrame([(0,), (1,), (1,), (None,), (99,)], "doc_id long")
    rows = {r.doc_id: r for r in lmscore.cross_entropy_difference(df, targets, size=3, smoothing=2.0).collect()}
    words = lmscore.vocabulary(df, 3)
    assert words == ["a", "b", "x"]
    number = {w: i + 1 for i, w in enumerate(words)}
    ids = [[number.get(w, 0) for w in (t or "").lower().split()] for t in texts]

    def table(members, scale):
        counts = np.zeros((5, 5))
        for i in members:
            for u, w in zip([4, *ids[i]], ids[i]):
                counts[u, w] += scale
        return counts

    target, every = table([0, 1], 1), table(range(7), 1)
    scale = target.sum() / every.sum()
    for i, seq in enumerate(ids):
        near = lmscore.losses(table({0, 1} - {i}, 1), 2.0)
        far = lmscore.losses(table(set(range(7)) - {i}, scale), 2.0)
        steps = list(zip([4, *seq], seq))
        expected = sum(far[u, w] - near[u, w] for u, w in steps) / max(1, len(steps))
        assert rows[i].n_tokens == len(seq) and abs(rows[i].score - expected) < 1e-5
    assert rows[0].background_loss == rows[6].background_loss and rows[6].score > rows[4].score


def test_lm_score_without_targets_or_rows(shipped):
    none = shipped.createDataFrame([], "doc_id long")
    assert lmscore.cross_entropy_difference(documents(shipped, ["a b"]), none).first().score == 0
    assert lmscore.cross_entropy_difference(documents(shipped, []), none).count() == 0


def test_messages_per_token_do_not_grow_with_the_corpus(shipped, monkeypatch):
    for name, value in {"BATCH_TOKENS": 100, "RANGE_TOKENS": 100, "FAN": 4}.items():
        monkeypatch.setattr(lmscore, name, value)
    rng = np.random.default_rng(9)
    rates = []
    for n in (40, 400):
        docs = documents(shipped, [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 100)) for _ in range(n)]).repartition(4)
        docs = docs.select(F.col("doc_id").alias("doc"), "text")
        texts = written(lmscore._batches(docs, None), "tokens")
        marks = texts.filter("place >= 0").select(F.col("batch").alias("of"), "place")
        sent = lmscore._sent(texts, marks, n, n)
        assert len(sent) == {40: 3, 400: 5}[n]
        for messages in sent:
            sizes = [r["count"] for r in messages.groupBy("at").count().collect()]
            assert max(sizes) <= 16  # some FAN senders
            rates.append(sum(sizes) / (100 * n))
    assert max(rates) <= 0.06 and max(rates[3:]) < 1.5 * max(rates[:3])


def test_no_receiver_gets_many_batches_just_above_the_fan(shipped, monkeypatch):
    """80 batches with a fan of 64 take two hops, but neither teams of 64 batches nor two ranges."""
    for name, value in {"BATCH_TOKENS": 200, "RANGE_TOKENS": 200, "FAN": 64}.items():
        monkeypatch.setattr(lmscore, name, value)
    rng = np.random.default_rng(10)
    docs = documents(shipped, [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 200)) for _ in range(80)]).repartition(2)
    texts = written(lmscore._batches(docs.select(F.col("doc_id").alias("doc"), "text"), None), "tokens")
    marks = texts.filter("place >= 0").select(F.col("batch").alias("of"), "place")
    sent = lmscore._sent(texts, marks, 80, 80)
    assert len(sent) == 2
    for messages in sent:
        loads = [r.entries for r in messages.groupBy("at").agg(F.sum("n").alias("entries")).collect()]
        assert max(loads) <= 4 * 604 and 80 * 590 <= sum(loads) <= 80 * 604  # 200 bigrams, 202 first and 202 second words a batch
    answers = lmscore._answered(sent)
    assert sum(r.n for r in answers.collect()) == sum(r.n for r in sent[0].collect())  # a batch gets an answer for all that it sent
    plan = answers._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count(" send(") == 1 and "ReusedExchange" in plan  # what is read on the way back is not made again


@pytest.mark.parametrize("fan", [2, 256])
def test_lm_score_knows_every_word_of_a_large_vocabulary(shipped, monkeypatch, fan):
    monkeypatch.setattr(lmscore, "BATCH_TOKENS", 4000)
    monkeypatch.setattr(lmscore, "RANGE_TOKENS", 1500)
    monkeypatch.setattr(lmscore, "FAN", fan)
    rng = np.random.default_rng(6)
    often = [f"often{i}" for i in range(2100)]
    texts = [" ".join([*often, *often]), "red fox", "blue fish", "red fox", "blue fish", "", None]
    texts += [" ".join(f"r{x}" for x in rng.integers(0, 5000, 300)) for _ in range(20)]
    df = documents(shipped, texts)
    targets = shipped.createDataFrame([(1,), (7,)], "doc_id long")
    rows = {r.doc_id: r for r in lmscore.cross_entropy_difference(df, targets).collect()}
    words = [(t or "").split() for t in texts]
    known = {w: i for i, w in enumerate(sorted({w for ws in words for w in ws}))}
    near, far = defaultdict(float), defaultdict(float)
    for i, ws in enumerate(words):
        for u, w in zip(["", *ws], ws):
            for key in ((u, w), (u, None), (None, w)):
                far[key] += 1
                near[key] += i in (1, 7)
    n_near, n_far = 302, sum(map(len, words))

    def loss(table, total, scale, u, w, own):
        count = lambda *key: (table[key] - own[key]) * scale
        share = (count(None, w) + 1) / ((total - own["n"]) * scale + len(known) + 2)
        return -np.log2((count(u, w) + 20 * share) / (count(u, None) + 20))

    for i, ws in enumerate(words):
        own = Counter(key for u, w in zip(["", *ws], ws) for key in ((u, w), (u, None), (None, w)))
        own["n"] = len(ws)
        mine = own if i in (1, 7) else Counter()
        a = sum(loss(near, n_near, 1, u, w, mine) for u, w in zip(["", *ws], ws)) / max(1, len(ws))
        b = sum(loss(far, n_far, n_near / n_far, u, w, own) for u, w in zip(["", *ws], ws)) / max(1, len(ws))
        assert rows[i].n_tokens == len(ws) and abs(rows[i].target_loss - a) < 1e-9
        assert abs(rows[i].background_loss - b) < 1e-9 and abs(rows[i].score - (b - a)) < 1e-9
    # all four words are rarer than 2048 others; the background has one more "red fox" than the target for either document
    assert rows[3].score > 0 > rows[2].score and rows[1].background_loss == rows[3].background_loss


def test_lm_score_tells_documents_that_occur_twice(shipped):
    """A document's own words do not lower its loss, those of a copy do."""
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 60) % 3000) for _ in range(300)]
    texts += texts[:40]
    rows = {r.doc_id: r.background_loss for r in lmscore.cross_entropy_difference(
        documents(shipped, texts), shipped.createDataFrame([(i,) for i in range(100, 160)], "doc_id long")).collect()}
    clean = sorted(rows[i] for i in range(40, 300))
    assert sum(rows[i] < clean[26] for i in range(40)) >= 38  # a tenth of the others
