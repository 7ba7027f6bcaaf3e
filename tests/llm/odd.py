import pytest

#: texts that every operator has to take: null, empty, white space, repeats, long
TEXTS = [None, "", " \t\n", "one", "The quick brown fox jumps over the lazy dog.", "The quick brown fox jumps over the lazy dog.",
         "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 400, "é ñ ß 日本 \U0001F600 ok\nline two\n\nline two\n"]


@pytest.fixture
def odd_docs(spark):
    """Odd texts, null and repeated ids, and columns with clashing names."""
    ids = [1, 2, 3, 4, 5, 5, None, None]
    rows = [(i, t, None if k % 3 else "en", f"s{k}", k, "x", k, "y", True)
            for k, (i, t) in enumerate(zip(ids, TEXTS))]
    rows.append((5, TEXTS[5], "en", "again", 1, "x", 1, "y", False))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "_key string, row long, words string, kept boolean")


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
