"""Small awkward inputs, and plain versions of what the operators compute."""

import random
import re

LONG = " ".join(f"word{i % 977} and more" for i in range(12_000))
SHORTS = ["the cat sat on the mat and ran", "ein kurzer Satz über Züge", "un été à la plage", "x", "a\tb\nc  d   e", "<|endoftext|> it's <|endoftext|>",
          " \x1c\x85 odd   white", "\U0001f600 smile աբ 中文 १२", "\x00\x01 nul", "!!!???***", "12 34 5678"]
SCHEMA = "doc_id long, text string, lang string, node long, key long, n long, hash long, row string, base string, score double, term string"


def rows():
    """Nulls, empty and blank texts, ties, repeated rows, equal ids with other texts, a long text."""
    out = [(i + 10, t) for i, t in enumerate(SHORTS)]
    out += [(1, None), (2, ""), (3, "   \n\t "), (None, "no id here at all today"), (None, None), (4, "the same text twice in two rows"),
            (4, "the same text twice in two rows"), (5, "the same text twice in two rows"), (6, "one id"), (6, "another text under it"), (7, LONG)]
    return [(i, t, "en", 1, 1, 1, 1, "r", "b", 0.5, "t") for i, t in out]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
