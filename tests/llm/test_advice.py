"""Cases in which the operators for training data once did less than the whole job."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from vasculum.llm import html_text, language, licences, quality


def test_html_keeps_siblings_of_the_article():
    body = "".join(f"<p>Body, paragraph, number {i}, with some more words in it, and commas.</p>" for i in range(8))
    text = "\n".join(f"Body, paragraph, number {i}, with some more words in it, and commas." for i in range(8))
    links = "<ul><li><a href=x>link a</a><li><a href=y>link b</a></ul>"
    pages = [
        (f"<div><h1>T</h1><p>lead</p><div class=body>{body}</div></div>", f"T\nlead\n{text}"),
        (f"<div><div class=body>{body}</div><div><h2>Second</h2><p>A short section.</p></div><ul><li>one<li>two</ul><h3>More</h3>{links}</div>", f"{text}\nSecond\nA short section.\none\ntwo"),
        (f"<div><h1><a href=x>T</a></h1>bare <b>text</b><section><div class=body>{body}</div></section><div><a href=x>nav</a></div><h2>End</h2></div>", f"T\nbare text\n{text}"),
    ]
    for html, want in pages:
        assert html_text.main_text(html) == want


def test_language_learns_from_distinct_texts(documents, monkeypatch):
    texts = [f"the dog number {chr(97 + i % 26)}{chr(97 + i // 26)} sleeps here with the cat" for i in range(60)]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    hot = [(1_000 + i, "zzz qqq xxx", "en") for i in range(300)]
    want = language.learn_profiles(documents([*rows, hot[0]]), F.lit(True))
    assert language.learn_profiles(documents(rows + hot), F.lit(True)) == want
    monkeypatch.setattr(language, "LEARN_DOCUMENTS", 30)
    drawn, langs = language._drawn(documents(rows + hot), F.lit(True), "text", "lang", language.LEARN_DOCUMENTS)
    found = [r.text for r in drawn.collect()]
    assert langs == ["en"] and len(found) == len(set(found)) and 10 <= len(found) <= 50
    assert language.learn_profiles(documents(rows + hot), F.lit(True)) == language.learn_profiles(documents([*rows, hot[0]]), F.lit(True))


def test_pipeline_rejects_unlearned_languages(spark, documents):
    import corpus_pipeline

    rng = random.Random(9)
    words = {
        "en": "the dog and cat do not sleep here when they can run with their friends over there".split(),
        "de": "der hund und die katze schlafen nicht wenn sie mit ihren freunden laufen dort".split(),
    }
    rows = [(i, " ".join(rng.choice(words[g]) for _ in range(40)), g) for i in range(200) for g in [("en", "de")[i % 2]]]
    junk = ["".join(rng.choice("bcdfghjklmnpqrstvwxz") for _ in range(400)), "xq zj kv " * 40, "мама мыла раму и пошла домой " * 8, " ".join("qxzjvkwpy"[k % 9] * 4 for k in range(90))]
    docs = documents(rows + [(1_000 + i, t, None) for i, t in enumerate(junk)] + [(2_000, "the dog and the cat", None), (2_001, "hund", None)])
    kept = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs, "").collect()}
    assert kept == {*range(200), 2_000, 2_001}


def test_quality_learns_from_distinct_texts(spark, documents, monkeypatch):
    rng = random.Random(10)
    good = [" ".join(rng.choice(["plain", "words", "make", "prose", "here."]) for _ in range(60)) for _ in range(60)]
    bad = [" ".join(rng.choice(["BUY!!", "$$$", "###", "NOW!!"]) for _ in range(60)) for _ in range(60)]
    texts = good + bad + ["hot text, plain words here."] * 400
    docs = documents([(i, t, "en") for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(120)] + [(i, int(i < 220)) for i in range(120, 520)], "doc_id long, quality int")
    voter = quality.learn(docs, labels, F.lit(True))
    assert len(voter.labels) == 121 and sorted(set(voter.labels.tolist())) == [0, 0.25, 1]
    monkeypatch.setattr(quality, "LEARN_DOCUMENTS", 20)
    voter = quality.learn(docs, labels, F.lit(True))
    assert 39 <= len(voter.labels) <= 40 and 19 <= (voter.labels == 1).sum() <= 20


def test_licences_wrapped_over_lines(documents):
    templates = dict((label, text) for text, label in licences.TEMPLATES)
    rng = random.Random(11)
    rows = [(i, "\n".join(" * " + " ".join(text.title().split()[k : k + 4]) for k in range(0, 30, 4)), "en") for i, text in enumerate(templates.values())]
    scattered = " ".join(w + " filler" * 20 for w in "released under the mit license".split())
    rows += [(50, scattered, "en"), (51, "filler " * 500 + rows[1][1] + " filler" * 500, "en"), (52, None, "en"), (53, "", "en")]
    pool = sorted({w for text in templates.values() for w in text.split()}) + ["other", "words"]
    for i in range(60, 90):
        words = " ".join(rng.choice(pool) for _ in range(40)) + "\n" + " ".join(w for w in rng.choice(licences.TEMPLATES)[0].split() for w in [w] * rng.choice([0, 1, 1, 1, 1, 2]))
        rows.append((i, words + "\n" + " ".join(rng.choice(pool) for _ in range(40)), "en"))
    found = {r.doc_id: r for r in licences.scan(documents(rows), windows=True).collect()}
    phrases = {tuple(p.split()): v for p, v in licences.PHRASES.items()}
    for i, text, _ in rows:
        words = re.findall("[0-9a-z]+", (text or "").lower())
        labels = {v for p, v in phrases.items() for k in range(len(words)) if tuple(words[k : k + len(p)]) == p}
        best = 1.0 if labels else 0.0
        for template, label in licences.TEMPLATES:
            tokens, width = set(template.split()), licences.WIDTH * len(template.split())
            share = max((len(tokens & set(words[k : k + width])) / len(tokens) for k in range(len(words))), default=0.0)
            if share >= 0.8:
                labels.add(label)
                best = max(best, share)
        assert found[i].labels == ",".join(sorted(labels)) and abs(found[i].score - best) < 1e-9, i
    for i, label in enumerate(templates):
        assert label in found[i].labels.split(",")
    assert found[50].labels == ""


def test_medians_are_those_of_all_texts(documents):
    """Thousands of distinct texts, some of them often, of two languages, an even and an odd number: the exact median of all, copies counted once."""
    rng = random.Random(5)
    words = {"en": "the dog and cat do not sleep here when they can run with their friends".split(), "de": "der hund und die katze schlafen nicht wenn sie mit ihren laufen".split()}
    texts = {g: sorted({" ".join(rng.choice(w) for _ in range(rng.randrange(2, 30))) for _ in range(n)}) for (g, w), n in zip(words.items(), (1_500, 1_401), strict=True)}
    rows = [(t, g) for g in texts for t in texts[g]] + [("the dog and the cat", "en")] * 200 + [(None, "en"), ("12 34", "de"), ("the dog and the cat", None)]
    docs = documents([(i, t, g) for i, (t, g) in enumerate(rows)])
    profiles = language.learn_profiles(docs, F.lit(True))
    got = language.learn_medians(docs, F.lit(True), profiles)
    identifier = language.Identifier(profiles)
    for g in texts:
        scores = sorted(score for lang, score in map(identifier, {t for t, lang in rows if t and lang == g}) if lang == g)
        middle = len(scores) // 2
        assert got[g] == (scores[middle] if len(scores) % 2 else (scores[middle - 1] + scores[middle]) / 2)
    assert language.learn_medians(docs, F.lit(False), profiles) == {} and language.learn_medians(docs, F.lit(True), {}) == {}
