import hashlib
import re

import pytest

from emporia.llm.common import prepare

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# Nulls, empty and white texts, ties, repeated rows, marks, other scripts, a long text.
LONG = " ".join(f"word{i % 977} of{i % 2}" for i in range(20_000))
ODD_TEXTS = [None, "", "   \n\t ", "one", "one two", "á éß 中文 \U0001f600!", "x" * 70_000, LONG, "same text here", "same text here", "\x00 nul \x1c end"]
# Letters outside NFC, and a capital whose lower case is longer, before marks.
ODD_TEXTS += ["ALİ, क़, שׁ. e\u0301, ﬁn! ΟΔΟΣ."]


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """Awkward documents: with a repeated row, repeated ids, a null id, null sources, and extra columns of clashing names."""
    rows = [(i, t, None, [None, "a", "b"][i % 3], 0) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[8], (3, "another text", "en", "b", 0), (None, "a row without id", "en", "a", 0)]
    rows = [(*r, 1, 2, 3, 4, 5, 6, 7) for r in rows]
    extra = ", size int, score int, fp int, shard int, target int, items int, `order` int"
    return spark.createDataFrame(rows, DOCUMENTS + extra).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)


def documents(spark, texts, sources=None):
    rows = [(i, t, "en", sources[i] if sources else "s", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(4)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
