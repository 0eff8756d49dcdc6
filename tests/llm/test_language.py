import random

import pytest

from cauldra.llm import language as lg

SAID = {
    "en": ["The small river runs behind our old house.", "Nobody knew where the letters had been hidden.", "We walked through the market before breakfast.", "She wrote down every word that he had spoken."],
    "de": ["Der kleine Fluss fließt hinter unserem alten Haus.", "Niemand wusste, wo die Briefe versteckt waren.", "Wir gingen vor dem Frühstück durch den Markt.", "Sie schrieb jedes Wort auf, das er gesagt hatte."],
    "fr": ["La petite rivière coule derrière notre vieille maison.", "Personne ne savait où les lettres étaient cachées.", "Nous avons traversé le marché avant le déjeuner.", "Elle a noté chaque mot qu'il avait prononcé."],
    "zh": ["小河在我们的老房子后面流过。", "没有人知道那些信藏在哪里。", "我们在早饭前走过了市场。", "她写下了他说过的每一个字。"],
    "ru": ["Маленькая река течёт за нашим старым домом.", "Никто не знал, где спрятаны эти письма.", "Мы прошли через рынок до завтрака.", "Она записала каждое слово, которое он сказал."],
}


@pytest.fixture(scope="module")
def fitted(spark):
    r, rows = random.Random(2), []
    for i in range(300):
        code = r.choice(list(SAID))
        label = {"en": "English", "de": "deu", "fr": "fr-CA", "zh": "ZH", "ru": "ru"}[code] if r.random() < 0.85 else r.choice(list(SAID))
        rows.append((i, " ".join(r.sample(SAID[code], 3)), label))
    return lg.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang")


def found(spark, fitted, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ident = lg.identify(df, "doc_id", "text", fitted, ["lang"])
    return {(r["doc_id"], r["lang"]) for r in lg.wrong_labels(ident, "doc_id", "lang").collect()}, {r["doc_id"]: r["segments"] for r in ident.collect()}


def test_held_out_sentences(fitted):
    scorer = lg.Scorer(fitted)
    held = {"en": "The old market stands before the river.", "de": "Der alte Markt steht hinter dem Haus.", "fr": "Le vieux marché est derrière la rivière.", "zh": "市场在小河的后面。", "ru": "Старый рынок стоит за рекой."}
    got = scorer.score([lg.plain(s) for s in held.values()])
    assert [lg.LANGUAGES[g] for g, _ in got] == list(held) and all(0.2 < sure <= 1 for _, sure in got)


def test_cases(spark, fitted):
    en, de, zh = SAID["en"][0], SAID["de"][1], SAID["zh"][0]
    rows = [(1, en, "en"), (2, en, None), (3, en, "German"), (4, f"{en} {de}", "en"), (5, f"{en}\n\n{zh}", "mul"), (6, "🍵🍵 95 / 6", None), (7, None, None), (8, "", ""), (9, en, "EN_us"), (10, "The small house (Frühlingsernte) stands behind the river.", "en"), (11, en, "  "), (12, en, "Korean")]
    cases, segments = found(spark, fitted, rows)
    assert cases == {(2, "en"), (3, "en"), (4, "en"), (4, "de"), (5, "en"), (5, "zh"), (11, "en"), (12, "en")}
    assert [s["lang"] for s in segments[4]] == ["en", "de"] and segments[6] == segments[7] == segments[8] == []
    s = segments[4][1]
    assert f"{en} {de}"[s["start"] : s["end"]].strip() == de


def test_long_text_and_empty_table(spark, fitted):
    _, segments = found(spark, fitted, [(1, " ".join(SAID["en"] * 2000), "en")])
    assert len(segments[1]) == 1
    assert found(spark, fitted, [])[0] == set()


def test_grams_do_not_cross_texts():
    a, b = lg.grams(["abc"]), lg.grams(["de"])
    owner, bucket = lg.grams(["abc", "de", ""])
    assert sorted(bucket[owner == 0]) == sorted(a[1]) and sorted(bucket[owner == 1]) == sorted(b[1])
    assert len(lg.grams([])[0]) == 0
