"""The operators against plain versions, and their defined results for unusual input."""

from __future__ import annotations

import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from vasculum.llm import divergence, dropout, html_text, language, lattice, licences, minhash, packing, preferences, quality
from vasculum.llm.components import connected_components

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    (1, None, None), (2, "", "en"), (3, "   \n\t ", "en"), (4, "one", None), (5, "one", "en"), (5, "one", "en"), (None, "no id here", "en"),
    (6, "naïve 日本 😀 ▁ <|endoftext|> <s>  two  spaces \x1c", "fr"), (7, "word " * 30_000, "en"),
]


def folder_of(spark, tmp_path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))


def components_of(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = chain + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(5, 5), (None, 3), (7, 200), (7, 200)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert found == components_of({n for e in real for n in e}, real)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packing(spark, documents):
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(BPE), random.Random(2)
    rows = ODD + [(100 + i, " ".join(rng.choice(["the", "grün", "xyzzy,", "12"]) for _ in range(rng.randrange(900))), "en") for i in range(60)]
    pieces = packing.with_crc(packing.pack(documents(rows), BPE), BPE).collect()
    want = Counter()
    for i, text, _ in rows:
        want[i, len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1] += 1
    assert sum(p.length for p in pieces) == sum(n * k for (_, n), k in want.items())
    texts = {i: t for i, t, _ in rows}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for i, own in by_doc.items():
        ids = np.array(tokenizer.encode(texts[i] or "", add_special_tokens=False).ids + [0], "<u4")
        copies = sum(k for (j, _), k in want.items() if j == i)
        cover = Counter(x for p in own for x in range(p.start, p.start + p.length))
        assert cover == dict.fromkeys(range(len(ids)), copies)
        for p in own:
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by_sequence) * 1024 < 1.03 * sum(p.length for p in pieces) + 1024
    assert packing.pack(documents([]), BPE).count() == 0


def test_language(spark, documents):
    german, english = "der hund und die katze schlafen nicht", "the dog and the cat do not sleep here"
    rows = [(i, english, "en") for i in range(10, 20)] + [(i, german, "de") for i in range(20, 30)]
    docs = documents(rows + ODD)
    profiles = language.learn_profiles(docs, F.lit(True))
    found = {(r.doc_id, r.lang_pred, r.score) for r in language.identify(docs.select("doc_id", "text"), profiles).collect()}
    by_id = {i: (g, s) for i, g, s in found}
    assert all(by_id[i][0] == "en" for i in range(10, 20)) and all(by_id[i][0] == "de" for i in range(20, 30))
    assert by_id[1] == by_id[2] == by_id[3] == ("und", 0.0) and by_id[4] == by_id[5]
    assert all(0 <= s <= 1 for _, _, s in found)
    kept = language.identify(docs, profiles, only_known=True)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    # The distance itself, by the definition.
    identifier = language.Identifier(profiles)
    grams, counts = np.unique(language.text_grams(german), return_counts=True)
    ranked = [int(g) for _, g in sorted(zip(-counts, grams, strict=True))][: language.DOCUMENT_GRAMS]
    distance = {
        lang: sum(abs(p.index(g) - k) if g in p else language.PROFILE_GRAMS for k, g in enumerate(ranked)) for lang, p in profiles.items()
    }
    best = min(sorted(distance), key=distance.__getitem__)
    assert identifier(german) == (best, pytest.approx(1 - distance[best] / language.PROFILE_GRAMS / len(ranked)))
    empty = documents([])
    assert language.learn_profiles(empty, F.lit(True)) == {} and language.identify(empty, {}).count() == 0
    assert language.identify(docs.select("doc_id", "text"), {}).filter("lang_pred <> 'und'").count() == 0


def test_quality(spark, documents):
    rng = random.Random(3)
    good = [" ".join(rng.choice(["plain", "words", "make", "prose", "here."]) for _ in range(60)) for _ in range(60)]
    bad = [" ".join(rng.choice(["BUY!!", "$$$", "###", "NOW!!"]) for _ in range(60)) for _ in range(60)]
    docs = documents([(i, t, "en") for i, t in enumerate(good + bad, 100)] + ODD)
    labels = spark.createDataFrame([(100 + i, int(i < 60)) for i in range(120) if i % 3] + [(None, 1), (5, None)], "doc_id long, quality int")
    voter = quality.learn(docs, labels, F.lit(True))
    found = quality.classify(docs.select("doc_id", "text"), voter).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    assert all(by_id[100 + i].predicted == int(i < 60) for i in range(120)) and by_id[1].score == by_id[2].score == 0
    # Votes by the definition.
    terms = np.stack([quality.term_vector(good[0])])
    cosine = voter._unit((terms * voter.weights - voter.mean) @ voter.projection) @ voter.latent
    near = np.argsort(-cosine[0])[: quality.NEIGHBOURS]
    votes = np.maximum(cosine[0][near].astype(float), 1e-3) ** quality.SHARPNESS
    assert voter.scores([good[0]])[0] == pytest.approx((votes * voter.labels[near]).sum() / votes.sum(), abs=1e-4)
    kept = quality.classify(docs, voter, only_good=True)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= set(range(100, 160))
    assert quality.learn(docs, labels.limit(0), F.lit(True)) is None
    assert quality.classify(docs, None, only_good=True).count() == docs.count()
    assert quality.classify(documents([]), voter).count() == 0


def test_dropout(spark, documents):
    import sentencepiece

    docs = documents(ODD + [(20, "the quick brown fox jumps over the lazy dog " * 5, "en"), (21, "the quick brown fox jumps over the lazy dog " * 5, "en")])
    texts = {i: t or "" for i, t, _ in ODD} | {20: "the quick brown fox jumps over the lazy dog " * 5}
    texts[21] = texts[20]
    encoded = dropout.encode(docs, PIECES, 0.2, 7)
    found = dropout.decode(encoded, PIECES).collect()
    assert len(found) == docs.count() and all(r.text == texts[r.doc_id] for r in found)
    assert sorted(map(str, found)) == sorted(map(str, dropout.decode(dropout.encode(docs.repartition(1), PIECES, 0.2, 7), PIECES).collect()))
    by_id = {r.doc_id: r.ids for r in found}
    assert by_id[20] != by_id[21]
    plain = {r.doc_id: r.ids for r in dropout.encode(docs, PIECES, 0.0).collect()}
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert all(plain[i] == model.encode(texts[i]) for i in (2, 3, 4, 7, 20)) and len(by_id[20]) > len(plain[20])
    assert dropout.encode(documents([]), PIECES).count() == 0


def test_dropout_agenda():
    """All words at once against one word at a time from an agenda, with the same skipped merges."""
    model, rng, rate = dropout.Model(PIECES), random.Random(4), 0.3
    words = ["▁" + "".join(rng.choice("theinréon▁"[:8]) for _ in range(rng.randrange(1, 14))) for _ in range(200)]
    seeds = np.array([rng.getrandbits(63) for _ in words], np.uint64)
    flat, counts = model.segment(words, seeds, rate)
    ends = np.cumsum(counts)
    limit = int(rate * 2**64)
    for w, word in enumerate(words):
        parts = [(k, k + 1, model.chars.get(ord(c), -1)) for k, c in enumerate(word)]
        while True:
            best = None
            for k, ((a, b, x), (_, c, y)) in enumerate(zip(parts, parts[1:], strict=False)):
                to = int(model.pair(np.array([x]), np.array([y]))[0])
                place = np.array([a << 42 | b << 21 | c], np.int64).astype(np.uint64)
                if to >= 0 and int(dropout._mixed(dropout._mixed(seeds[w : w + 1] ^ place))[0]) >= limit:
                    best = max(best or (-1,), (int(model.rank[to]), -k, to))
            if best is None:
                break
            k = -best[1]
            parts[k : k + 2] = [(parts[k][0], parts[k + 1][1], best[2])]
        assert [x for _, _, x in parts] == flat[ends[w] - counts[w] : ends[w]].tolist()


def test_dropout_of_long_words():
    """A word with an agenda of its own against the same word among short ones."""
    model, rng = dropout.Model(PIECES), random.Random(14)
    words = ["▁" + "".join(rng.choice("theinréon日") for _ in range(n)) for n in (61, 80, 300, 5, 61)]
    seeds = np.array([rng.getrandbits(63) for _ in words], np.uint64)
    for rate in (0.0, 0.1, 0.9):
        flat, counts = model.segment(words, seeds, rate)
        want, sizes = model._segment_short(words, seeds, rate)
        assert flat.tolist() == want.tolist() and counts.tolist() == sizes.tolist()
    for place in (dropout._place(1, 2, 3), dropout._place(1, 2, 1 << 22)):
        assert dropout._mixed_one(place) == int(dropout._mixed(np.array([place], np.uint64))[0])
    start = time.perf_counter()
    assert model.segment(["▁" + "这是中文" * 25_000], seeds[:1], 0.1)[1][0] > 0
    assert time.perf_counter() - start < 30


def test_dropout_varies_with_every_occurrence(spark, documents):
    """Frequent words have as many segmentations as chance gives them."""
    docs = documents([(i, "international " * 50, "en") for i in range(40)])
    table, pieces = dropout.Model(PIECES).table, Counter()
    for r in dropout.encode(docs, PIECES, 0.3, 3).collect():
        words: list[list[int]] = []
        for i in r.ids:
            if table[i].startswith(b" "):
                words.append([])
            words[-1].append(i)
        pieces.update(map(tuple, words))
    assert len(pieces) > 30


def test_preferences(spark):
    turn = "pair_id long, side string, turn int, role string, text string, prompt string"
    rows = [
        (1, "chosen", 0, "user", "hi", "x"), (1, "chosen", 1, "assistant", "good", "x"), (1, "rejected", 0, "user", "hi", "x"), (1, "rejected", 1, "assistant", "bad", "x"),
        (2, "chosen", 0, None, None, "x"), (2, "chosen", 1, "assistant", "same", "x"), (2, "rejected", 0, None, None, "x"), (2, "rejected", 1, "assistant", "same", "x"),
        (3, "chosen", 0, "user", "a<|im_end|>b", "x"), (None, "rejected", 0, "assistant", "é", "x"), (4, "other", 0, "user", "x", "x"),
    ]
    found = {r.pair_id: r for r in preferences.format_preferences(spark.createDataFrame(rows, turn)).collect()}
    one = found[1]
    assert (one.n_common, one.prompt, one.usable) == (1, "<|im_start|>user\nhi<|im_end|>\n", True)
    assert one.chosen == "<|im_start|>assistant\ngood<|im_end|>\n" and one.rejected == "<|im_start|>assistant\nbad<|im_end|>\n"
    for text, spans, said in ((one.chosen, one.chosen_spans, "good"), (one.rejected, one.rejected_spans, "bad")):
        assert [text[s.start : s.start + s.length] for s in spans] == [said + "<|im_end|>"]
    assert (found[2].n_common, found[2].chosen, found[2].usable) == (2, "", False) and "<|im_start|>user\n<|im_end|>" in found[2].prompt
    assert found[3].chosen.count("<|im_end|>") == 1 and found[3].rejected == "" and found[None].n_common == 0 and 4 not in found
    assert preferences.format_preferences(spark.createDataFrame([], turn)).count() == 0


def test_lattice(spark):
    rng = np.random.RandomState(5)
    base = rng.randn(40, 64)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(base)]
    for i in range(200):
        a = base[i % 12] / np.linalg.norm(base[i % 12])
        z = rng.randn(64)
        z -= (z @ a) * a
        c = rng.uniform(0.94, 1)
        rows.append((100 + i, (rng.uniform(0.1, 9) * (c * a + math.sqrt(1 - c * c) * z / np.linalg.norm(z))).tolist(), 1))
    rows += [(400 + i, base[0].tolist(), 2) for i in range(3)] + [(400, base[0].tolist(), 2)]
    rows += [(500, None, 0), (501, [], 0), (502, [0.0] * 64, 0), (503, [float("nan")] * 64, 0), (504, [1.0, None], 0), (505, [1.0, 2.0], 0), (None, base[1].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, weight int").repartition(5)
    found = lattice.near_duplicates(df).collect()
    good = [(i, np.array(v)) for i, v, _ in rows if i is not None and v and len(v) == 64 and np.isfinite(v).all() and np.any(v)]
    unit = np.stack([v / np.linalg.norm(v) for _, v in good])
    near = unit @ unit.T >= 0.95
    links = (near.sum() - len(good)) / 2
    got = {(r.vec_id, r.n_links) for r in found if r.vec_id is not None}
    # The row without id counts as a link of vector 1, its equal, and of those near to that.
    beside = sum(near[k].sum() for k, (i, _) in enumerate(good) if i == 1)
    total = sum(r.n_links for r in found if r.vec_id is not None)
    assert 0.9 * 2 * links <= total <= 2 * links + beside and len(found) == len(rows)
    most = {i: near[k].sum() - 1 for k, (i, _) in enumerate(good)}
    to_one = {good[k][0] for k in np.flatnonzero(near[[g[0] for g in good].index(1)])}
    assert all(r.n_links <= most[r.vec_id] + (r.vec_id in to_one) for r in found if r.vec_id in most and r.vec_id != 400)
    want = components_of({i for i, _ in good}, [(good[a][0], good[b][0]) for a, b in zip(*np.nonzero(near), strict=True)])
    same = sum(r.component_id == want[r.vec_id] for r in found if r.vec_id in want)
    assert same >= 0.95 * len(good)
    assert all((i, 0) in got for i in (500, 501, 502, 503, 504, 505))
    points = rng.randn(300, 8) * 2
    nearest = lattice.nearest_e8(points)
    gap = ((points - nearest) ** 2).sum(1)
    assert all((((points - nearest - r) ** 2).sum(1) >= gap - 1e-9).all() for r in lattice._roots())
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_lattice_blocks(spark, monkeypatch):
    rng = np.random.RandomState(6)
    a = rng.randn(64)
    rows = [(i, (a + rng.randn(64) * 0.02).tolist()) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = sorted((r.vec_id, 149, 0, r.vec_id == 0) for r in df.collect())
    for block in (1_000, 40):
        monkeypatch.setattr(lattice, "BLOCK", block)
        assert sorted(tuple(r) for r in lattice.near_duplicates(df).collect()) == want


@pytest.mark.parametrize("few", [0, 32])
def test_lattice_recall_by_size(spark, monkeypatch, few):
    """Pairs just over the threshold in 8 to 768 dimensions: nine in ten are found at least, and none that is not there."""
    monkeypatch.setattr(lattice, "FEW", few)
    rng = np.random.RandomState(9)
    rows, planted, linked = [], [], {}
    for size in (8, 16, 24, 32, 64, 384, 768):
        base = rng.randn(60, size)
        base /= np.linalg.norm(base, axis=1, keepdims=True)
        z = rng.randn(60, size)
        z -= (z * base).sum(axis=1, keepdims=True) * base
        c = rng.uniform(0.9501, 0.96, (60, 1))
        both = np.concatenate([base, c * base + np.sqrt(1 - c * c) * z / np.linalg.norm(z, axis=1, keepdims=True)])
        start = len(rows)
        rows += [(start + k, v.tolist()) for k, v in enumerate(both)]
        unit = both / np.linalg.norm(both, axis=1, keepdims=True)
        near = unit @ unit.T >= 0.95
        linked |= {start + k: int(n) - 1 for k, n in enumerate(near.sum(axis=1))}
        planted.append(range(start, start + 60))
    found = {r.vec_id: r for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()}
    assert all(found[i].n_links <= n for i, n in linked.items())
    for ids in planted:
        assert sum(found[i].component_id == found[i + 60].component_id for i in ids) >= 54


def test_lattice_cells_are_selective():
    """Vectors that have nothing in common seldom meet, whatever their size."""
    rng = np.random.RandomState(3)
    for size in (16, 64, 384, 768):
        own, near = lattice.cells(rng.randn(600, size))
        entries = near.reshape(600, lattice.TABLES, -1)
        met = np.zeros((600, 600), bool)
        for t in range(lattice.TABLES):
            asks = (entries[:, t, :, None] == own[None, None, :, t].reshape(1, 1, -1)).any(axis=1)
            met |= asks | asks.T | (own[:, t, None] == own[None, :, t])
        assert (met.sum() - 600) / (600 * 599) < 0.01


PAGES = [
    ("<html><body><nav><a href=x>Menu</a></nav><header>Top</header><div class='sidebar'><p>Side, bar, text.</p></div><article><h1>Title</h1>"
     "<p>First, with &amp; and &#233;.<br>Second  line<p>Third <b>bold</b> text</article><div id=comments><p>Nice, post, really, good</p></div>"
     "<footer>&copy; x</footer></body>", "Title\nFirst, with & and é. Second line\nThird bold text"),
    ("<div><p>Only, a paragraph of text.</p><script>var a='</p>';</script><style>p{}</style></div>", "Only, a paragraph of text."),
    ("<div class=content><p>One, two, three words.</p><ul><li>item one<li>item two</ul><form><input>Name</form></div><div><a href=y>link</a></div>",
     "One, two, three words.\nitem one\nitem two"),
    (None, ""), ("", ""), ("<", "<"), ("<!-- open", ""), ("</p></div>", ""),
]


def test_html(spark):
    rows = [(i, f"u{i}", h, "x") for i, (h, _) in enumerate(PAGES)] + [(None, None, PAGES[0][0] * 200, "x"), (3, "u3", None, "x")]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    by_id = {r.page_id: r.text for r in found}
    for i, (_, text) in enumerate(PAGES):
        assert by_id[i] == text, i
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("words", [2, 5])
def test_minhash(spark, documents, words, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 20)
    monkeypatch.setattr(minhash, "VERIFY", 5)
    rng = random.Random(6)
    texts = [[rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(rng.randrange(30, 120))] for _ in range(12)]
    rows = list(ODD)
    for i in range(90):
        copy = list(texts[i % 12])
        for _ in range(rng.choice([0, 1, 2, 4, 8])):
            copy[rng.randrange(len(copy))] = "new"
        rows.append((100 + i, " ".join(copy).upper() if i % 5 == 0 else " ".join(copy), "en"))
    docs = documents(rows)
    sets = {}
    for i, text, _ in rows:
        found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        width = min(words, len(found))
        sets[i] = {tuple(found[k : k + width]) for k in range(len(found) - width + 1)} if found else set()
    ids = [i for i in sets if i is not None]
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = components_of(ids, links)
    found = minhash.near_duplicates(docs, words).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.n_shingles == len(sets[r.doc_id])
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)
    left = minhash.keep_one(docs, words)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.filter("doc_id is not null").collect()) == sorted(i for i in ids if want[i] == i)
    assert left.filter("doc_id is null").count() == 1
    assert minhash.near_duplicates(documents([])).count() == 0


def base_features(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def test_divergence(spark, documents):
    rng = random.Random(7)
    rows = list(ODD) + [(50 + i, "the cat of a house and it was " * rng.randrange(1, 4) + " ".join(rng.choice("abcde") * 3 for _ in range(40)), "en") for i in range(30)]
    rows += [(90, "a b c d e f\nx y\nx y\na b c d e f # | <", "en"), (91, "$$$ ### %%% |||" * 40, "en")]
    docs = documents(rows)
    found = divergence.judge(docs, reference_words=100).collect()
    texts = {i: t for i, t, _ in rows}
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_features(texts[r.doc_id]), r.doc_id
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
        assert all(x is None or 0 <= x <= 1 for x in (r.class_distance, r.word_distance))
        assert (r.class_distance is None) == (r.n_words < 30)
    counts, reference = [3, 0, 5, 2], [0.1, 0.4, 0.5, 0.0]
    got = spark.createDataFrame([(counts,)], "c array<long>").select(divergence._distance(F.col("c"), F.lit(10), reference)).first()[0]
    p = [x / 10 for x in counts]
    total = sum(a * math.log2(2 * a / (a + b)) for a, b in zip(p, reference, strict=True) if a) + sum(b * math.log2(2 * b / (a + b)) for a, b in zip(p, reference, strict=True) if b)
    assert got == pytest.approx(math.sqrt(total / 2))
    assert divergence.judge(documents([])).count() == 0


def test_licences(spark, documents):
    rows = list(ODD) + [
        (50, "Released under the MIT License.\nText and more", "en"), (51, "x CC-BY/NC 4.0, cc by nc", "en"), (52, "Apache License, Version 2.0", "en"),
        (53, "text\nThis work is licensed under the GNU General Public License, version 3.\n", "en"), (54, "unlicense under the mit licenses ccc by nc", "en"),
        (55, "this work is under the\nGNU General Public License version 3 licensed", "en"), (56, "Äunder the mit license é under the mit license", "en"),
    ]
    found = {r.doc_id: r for r in licences.scan(documents(rows)).collect()}
    phrases = {tuple(p.split()): v for p, v in licences.PHRASES.items()}
    order = {w: k for k, w in enumerate(sorted({w for t, _ in licences.TEMPLATES for w in t.split()}))}
    assert order
    for i, text, _ in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        places = [(k, v) for p, v in phrases.items() for k in range(len(words)) if tuple(words[k : k + len(p)]) == p]
        labels, best = {v for _, v in places}, 1.0 if places else 0.0
        for line in (text or "").split("\n"):
            block = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line.translate({c: c + 32 for c in range(65, 91)})))
            for template, label in licences.TEMPLATES:
                tokens = set(template.split())
                share = len(tokens & block) / len(tokens)
                if share >= 0.8:
                    labels.add(label)
                    best = max(best, share)
        r = found[i]
        assert (r.n_words, r.n_base) == (len(words), len(places)), i
        assert (r.first_word, r.last_word) == (min((k for k, _ in places), default=None), max((k for k, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({v for _, v in places})) and r.labels == ",".join(sorted(labels)) and r.score == pytest.approx(best)
    assert licences.scan(documents([])).count() == 0


def test_pipeline(spark, documents, tmp_path):
    import corpus_pipeline

    rng = random.Random(8)
    prose = [" ".join(rng.choice(["plain", "words", "make", "prose", "here.", "and", str(i)]) for _ in range(60)) for i in range(20)]
    junk = [" ".join(rng.choice(["BUY!!", "$$$", "###", "NOW!!"]) for _ in range(60)) for _ in range(20)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(prose + junk + prose[:5] + ["12 34 56 $ 78"])] + [(None, None, None, None, None)]
    folder_of(spark, tmp_path, "documents", rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder_of(spark, tmp_path, "labels", [(i, int(i < 20), 0) for i in range(40)], "doc_id long, quality int, toxic int")
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(range(20))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_dropout_of_words_at_once_is_that_of_each_alone():
    """All words of a part, worked on at once, have the ids of an agenda of their own for each."""
    model = dropout.Model(public_tokenizers.path("piece_bpe_32k.model"))
    words = ["▁straight", "▁", "▁naïve", "x", "▁a" + dropout.LITERAL, "▁語彙", "▁tokenisation"] * 5
    seeds = dropout._mixed(np.arange(len(words)).astype(np.uint64))
    flat, counts = model.segment(words, seeds, 0.3)
    alone = [model.segment_alone(w, int(s), int(0.3 * 2**64)) for w, s in zip(words, seeds, strict=True)]
    assert counts.tolist() == [len(x) for x in alone] and flat.tolist() == [i for x in alone for i in x]
