import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from clickloom.llm.deploy import ready

    return ready(spark)


WORDS = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omikron pi rho sigma tau upsilon phi chi psi "
         "omega uno dos tres quatro cinco seis siete ocho nueve diez once doce trece catorce quince").split()


def prose(n, seed):
    """``n`` words, the same for the same seed."""
    import random

    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "s", "en"]) for _ in range(n))


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    *[T.StructField(c, T.StringType()) for c in
      ("size", "node", "key", "copies", "shard", "_key", "_place", "_at", "_range", "_source", "_class", "kept", "target", "label", "_of")]])


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *["x"] * 15)


def hard_rows():
    base = prose(60, 1)
    long = "\n".join(prose(40, i) for i in range(300))
    return [
        row(1, base), row(2, base), row(3, base + " extra"), row(4, prose(70, 2)), row(5, None), row(6, ""), row(7, " \n\t "),
        row(8, "one"), row(9, "one"), row(10, long, None, None), row(None, prose(50, 3), None, "b"), row(None, base, "de", None),
        row(11, prose(80, 4), "de", "b"), row(11, prose(80, 4), "de", "b"), row(12, "naïve café über ñandú " * 30, "fr", ""),
        row(13, "###$$$ %%% <b> | & *", "en", "c"), row(14, "Ж 中文 𝒳 é\n\nfin", "ru", "c"), row(15, "日本語" * 500, None, "c")]


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
