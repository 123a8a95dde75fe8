"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

DOCUMENTS = """doc_id long, text string, lang string, source string, n_chars long, name string, row long, part string,
    _row_number int, _spans string, number string, spans int, uid string, label string, cluster int, place string, leaf int,
    fp string, word int"""
LONG = " ".join(f"word{n % 997} of{n % 13}" for n in range(6000))
WORDS = " ".join(f"w{n}" for n in range(70))


def documents(spark, extra: tuple[tuple[int | None, str | None], ...] = ()):
    """Documents with extra columns whose names the operators use inside."""
    rows = [
        (0, "The cat sat on the mat."), (1, "THE CAT sat on the mat."), (2, None), (3, ""), (4, " \n\t "),
        (5, LONG), (6, LONG), (7, LONG + " tail"), (8, WORDS), (9, "before " + WORDS.upper() + " after"),
        (10, "a  b\n\n c <|endoftext|> d"), (10, "a  b\n\n c <|endoftext|> d"), (None, "no id here"),
        (None, None), (11, "é́ ñ 漢字 😀 it's"), (12, "x" * 5000), *extra,
    ]
    return spark.createDataFrame(
        [(i, t, "en", "s", None if t is None else len(t), "n", 1, "p",
          7, "s", "n", 3, "u", "l", 5, "p", 1, "f", 2) for i, t in rows], DOCUMENTS)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
