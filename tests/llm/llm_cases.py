"""Small inputs with the awkward cases that every operator must take."""

from __future__ import annotations

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Extra columns whose names the operators use inside.
CLASHING = {"print": "1", "words": "'x'", "label": "'y'", "uid": "3", "rank": "4", "fp": "5", "score": "0.5",
            "lang_pred": "'zz'", "entities": "'e'", "length": "6", "n": "7", "key": "8", "low": "9", "__other": "10",
            "__id": "11", "__print": "12", "__row": "13", "row": "14", "c0": "15", "a.b": "16", "hash": "17", "items": "18"}
SYLLABLES = "ka re mi to su la ne ho vi da pe ru".split()


def invented(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]
    return " ".join(w.capitalize() + "." if rng.random() < 0.1 else w for w in words)


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    """Invented texts and copies, nulls in every column, empty, blank and very long texts, repeated rows and ids."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = invented(rng, rng.choice([3, 9, 30, 120]))
        if i % 7 == 0 and i:
            text = out[i // 2][1]
        if i % 11 == 0 and i:
            text = (out[i - 1][1] or "") + " tail"
        out.append((i, text, ["en", "fr"][i % 2], f"s{i % 3}", len(text)))
    long = invented(rng, 4000)
    out += [
        (None, "a null id " + invented(rng, 15), "en", None, None),
        (None, None, None, None, None),
        (n, None, "en", "s", 0),
        (n + 1, "", "fr", "s", 0),
        (n + 2, " \t\n\x0b\x0c\r ", "fr", "s", 7),
        (n + 3, "123 456 !!", None, "s", 10),
        (n + 4, long, "en", "s", len(long)),
        (n + 5, "É̂ İ ſ 字 🙂 'tis <|endoftext|> don't\x00x", "fr", "s", 5),
        (n + 6, "same row", "en", "s", 8),
        (n + 6, "same row", "en", "s", 8),
        (n + 6, "other text, same id " + invented(rng, 20), "en", "s", 8),
    ]
    return out


def frame(spark, data: list[tuple], extra: bool = False):
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    return df.selectExpr("*", *[f"{v} AS `{k}`" for k, v in CLASHING.items()]) if extra else df


def spaced(text: str | None) -> list[str]:
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def lettered(text: str | None) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def as_set(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
