import pytest

# Null, empty, blank-only, special strings, odd white space, marks, long runs and repeated rows.
ODD = [
    (1, "Anna wrote to a.b@mail.example.org, and 10.0.0.256 to 10.0.0.255"),
    (2, ""),
    (3, None),
    (4, "  a  b \n\n c"),
    (5, "x<|endoftext|> y<|endoftext|> <s> </s> <0x0A>"),
    (6, "ÀÉ ﬁ Ａ １２３ don't I'LL ΣΑΣ İSTANBUL ß"),
    (7, "\x1c a \x1d\x85b\u3000\u00a0c\td  e"),
    (8, "日本語テキスト 😀😀 ▁▁x ▁ é ́x"),
    (9, "a" * 5000),
    (10, "word " * 3000),
    (11, "!!! ... ,,, \n \n  "),
    (1, "Anna wrote to a.b@mail.example.org, and 10.0.0.256 to 10.0.0.255"),
    (None, "no id"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Edge rows with extra columns named like the operators' results."""
    rows = [(k, t, "x", 0, "y", 1.0) for k, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, n_tokens int, spans string, score double")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
