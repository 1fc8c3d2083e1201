"""Small corpora for the tests of the training-data operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that clash with names the operators use inside.
CLASH = ", score double, fp long, chunk int, word string, size int, n long, signature long, part int"
_SYLLABLES = "ba ke li mo nu ra si to vu ze pla dro mi ne co ta".split()


def words(rng, n, vocabulary=4000):
    out = []
    for _ in range(n):
        k = int(rng.random() ** 2 * vocabulary)
        out.append("".join(_SYLLABLES[(k // 16**i) % 16] for i in range(1 + k % 3)) + _SYLLABLES[k % 16])
    return out


def text(rng, n):
    return " ".join(words(rng, n))


def rows(texts, **columns):
    """Rows of DOCS; columns may give lists of lang or source."""
    return [
        (
            i, t, columns["lang"][i] if "lang" in columns else "en",
            columns["source"][i] if "source" in columns else f"s{i % 3}", len(t or ""),
        )
        for i, t in enumerate(texts)
    ]


def frame(spark, data, clash=False):
    if not clash:
        return spark.createDataFrame(data, DOCS)
    return spark.createDataFrame([(*r, 0.5, 1, 2, "w", 3, 4, 5, 6) for r in data], DOCS + CLASH)


def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    rng = random.Random(3)
    long = text(rng, 30_000)
    same = text(rng, 80)
    return [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n ", None, None, None),
        (4, long, "en", "a", len(long)), (5, same, "en", "b", 1), (5, same, "en", "b", 1),
        (6, same, None, "b", 1), (None, same, "en", None, 1), (None, None, None, None, None),
        (7, "éß中文 \U0001f600 #%", "fr", "b", 1), (8, "x" * 5000, "en", "b", 1),
        (9, "be " * 3000, "en", "a", 1), (10, "1234 !!", "en", "a", 1),
    ]
