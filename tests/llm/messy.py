"""Small tables with everything that operators must bear."""

import random

LONG = "langer Text mit Wörtern, " * 4000
TEXTS = [
    "The quick brown fox jumps over the lazy dog and runs away from the farm.",
    "The quick brown fox jumps over the lazy dog and runs away from the farm.",
    "Le renard brun saute par-dessus le chien paresseux, et il s'en va très vite.",
    None,
    "",
    " \t\n ",
    "12345 --- 67890",
    "naïve café — “quotes” 日本語 😀 é",
    "x",
    LONG,
    LONG + "ende",
    "aaaa" * 300,
    "don't   stop\n\n\nit's  we'll   \t end  ",
]


def documents(spark, texts=TEXTS, ids=None):
    """A documents table; the last row is there twice, one row has no id, and other columns bear names used within."""
    ids = list(range(len(texts))) if ids is None else ids
    langs = ["en", "en", "fr", None, "en", None, None, None, "fr", "de", "de", None, "en"]
    sources = ["b", None, "a", "b", "ü", "a", None, "A", "b", "b", "a", "b", "b"]
    rows = [
        (i, text, langs[k % 13], sources[k % 13], None if text is None else len(text), -k, "h", k, "m")
        for k, (i, text) in enumerate(zip(ids, texts))
    ]
    rows += [(*rows[-1][:5], -99, "h", 99, "m"), (None, "no id", "en", "b", 5, None, None, None, None)] if rows else []
    schema = "doc_id long, text string, lang string, source string, n_chars long, d long, h string, n long, fingerprint string"
    return spark.createDataFrame(rows, schema)


def words(seed, count):
    """Invented prose."""
    draws = random.Random(seed)
    return " ".join("".join(draws.choice(["ba", "ri", "to", "ne", "su", "lak"]) for _ in range(draws.randint(1, 4))) for _ in range(count))
