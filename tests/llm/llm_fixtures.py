"""Small documents with every odd case, and brute-force helpers."""

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    # names that the operators use themselves
    + [T.StructField(name, T.StringType()) for name in ("row", "rank", "key", "copy", "kind", "row_", "gone_", "lower", "letter")]
)

VOICES = {
    "en": "the of and that with this from which have been their would about other after under while water house people".split(),
    "de": "der die das und nicht mit eine werden zwischen haben durch über schön straße jahr leben größe wissen möchte".split(),
    "fr": "le la les des dans est une avec pour être où après déjà garçon même élève très fenêtre château".split(),
}


def prose(rng: random.Random, lang: str, n: int) -> str:
    words = [rng.choice(VOICES[lang]) + rng.choice(["", "", "", ",", ".", ".\n"]) for _ in range(n)]
    return " ".join(words)


def documents(n: int = 90, seed: int = 5) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars, ...): prose with copies, near copies, shared passages and odd cases."""
    rng = random.Random(seed)
    passage = prose(rng, "en", 80)
    out = []
    for k in range(n):
        lang = rng.choice(list(VOICES))
        text = prose(rng, lang, rng.randint(1, 160))
        if k % 9 == 0 and out:
            text = rng.choice(out)[1]
        elif k % 9 == 1 and out:
            words = rng.choice(out)[1].split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif k % 9 == 2:
            text = text + "\n" + passage + "\n" + prose(rng, lang, 20)
        out.append((3 * k, text, lang if k % 7 else None, rng.choice(["a", "b", "c", "d", None])))
    odd = [None, "", " \n\t ", "x", "12 34", "same line\nsame line\nsame line\nsame line", "it's “quoted” — 日本語 <|endoftext|> İ", "A" * 3000, "ab " * 60_000, "\x00nul\x00" * 30]
    out += [(1000 + k, text, "en", "a") for k, text in enumerate(odd)]
    out += [(1000 + k, text, "en", "a") for k, text in enumerate(odd[:6])]  # repeated rows
    out += [(None, "no id here", "en", None), (None, None, None, None)]
    return [(*r, len(r[1]) if r[1] is not None else None, *["clash"] * 9) for r in out]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(5)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
