"""Small tables with what a corpus can hold: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, g int, text_key string, kept boolean, first string"
PASSAGE = " ".join(f"pass{k} age{k * 7 % 13}" for k in range(40))


def sentence(seed: int, n: int) -> str:
    out, state = [], seed * 7919 + 17
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        out.append("".join("bcdfglmnprstaeiou"[(state >> s) % 17] for s in range(3, 3 + 3 * (3 + state % 5), 3)))
    return " ".join(out)


def texts() -> list[tuple]:
    found = [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r "),
        (4, "one"),
        (None, "no id but words " + sentence(4, 60)),
        (5, sentence(5, 30_000)),
        (6, "x" * 200_000),
        (7, "\n" * 3000),
        (8, "Été ÀÉ ß 中文 😀 ▁   é </s> <|im_end|> \\ \x00 \x1c a"),
        (9, sentence(9, 300)),
        (9, sentence(9, 300)),
        (10, "A Line\nB line \n a line\nend"),
    ]
    found += [(20 + k, f"{sentence(20 + k, 70)} {PASSAGE} {sentence(60 + k, 50)}") for k in range(4)]
    found += [(30 + k, f"shared top line\n{sentence(30 + k, 20)}\n  SHARED top LINE\t") for k in range(12)]
    base = sentence(77, 400).split()
    found += [(50 + k, " ".join(base[:k] + ["changed"] + base[k + 1 :])) for k in range(6)]
    found += [(60, sentence(61, 200)), (61, sentence(61, 200))]
    return found


def table(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "xx", "s", len(t or ""), "r", 1, "k", True, "f") for i, t in rows], SCHEMA)
