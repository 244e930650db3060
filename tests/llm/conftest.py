"""Documents for the operators' tests: nulls, empty, blank and very long texts, repeated rows, copies, clashing columns."""

import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns with names that operators might use themselves.
CLASHING = "id long, row string, n int, h string, part int, score double, lang_pred string, gone string, bucket int, size int, n_removed string, text_sha256 string"


def words(text):
    return WORD.findall(text or "")


def make_docs(seed=0, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgßéñ") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts = []
    for i in range(n):
        lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 30))) for _ in range(rng.randint(1, 6))]
        text = "\n".join(lines)
        if i % 5 == 0:
            text += "\n" + passage
        if i % 7 == 3:
            base = texts[rng.randrange(len(texts))] or ""
            w = base.split(" ")
            if len(w) > 20:
                w[rng.randrange(len(w))] = "changed"
            text = " ".join(w)
        if i % 11 == 4:
            text = texts[rng.randrange(len(texts))]
        texts.append(text)
    texts += [None, "", "   \n\t ", "one", "Two words", "\n\n\n", " ".join(rng.choice(vocabulary) for _ in range(20_000)), "x" * 50_000, "same\x0bwords here", "same words\x0chere", passage.upper(), "a b c d e f g", passage + " " + passage]
    rows = [(10 * i + 3, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "Z", None]), len(t or "")) for i, t in enumerate(texts)]
    return rows


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = [f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in CLASHING.split(", ")]
    return df.selectExpr("*", *clash).repartition(3)


@pytest.fixture(scope="session")
def rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return table(spark, rows)


@pytest.fixture(scope="session")
def null_ids(spark, rows):
    """Rows with null ids and repeated rows."""
    return table(spark, [(None, "a b c d e f g h i j k l m n o p", None, None, None), (None, "a b c d e f g h i j k l m n o p", "en", "a", 1), (None, None, None, None, None), (5, "repeated row", "en", "a", 1), (5, "repeated row", "en", "a", 1)])


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
