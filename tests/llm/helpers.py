"""Small corpora for the operator tests: nulls, empties, ties, copies and clashing columns."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, template string, bucket int, h long"


def sentence(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def corpus(spark, extra=()):
    rng = random.Random(4)
    en = [a + b for a in ("the", "wh", "tion", "ing", "ab") for b in ("er", "on", "a", "ly", "th", "ea")]
    fr = [a + b for a in ("é", "que", "oi", "eau", "ç") for b in ("ment", "le", "ou", "è", "ai", "re")]
    texts = []
    for k in range(40):
        words, lang = (en, "en") if k % 2 else (fr, "fr")
        body = sentence(rng, 30 + 7 * k, words)
        texts.append((k, ("Page 12 of the Site\n" if k % 3 else "") + body, lang))
    long = sentence(rng, 3000, en)
    texts += [(50, None, None), (51, "", "en"), (52, " \n\t ", "en"), (53, "word", None), (54, long, "en"), (55, long + " tail", "en"),
              (56, texts[4][1], "fr"), (57, texts[4][1], "fr"), (58, texts[5][1] + " more", "en"), (None, texts[6][1], None),
              (59, "1234 5678 !!! ###", None), (60, "The\x0bThe x  y", "en"), (3, texts[3][1], "en"), (3, texts[3][1], "en"),
              (61, "Ünï 漢字 😀 <s> ▁ x", "en"), *extra]
    return spark.createDataFrame([(i, t, g, "s", len(t or ""), 0.5, "t", 1, 2) for i, t, g in texts], SCHEMA)


def plain(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def order(row):
    return tuple((x is not None, x) for x in row)
