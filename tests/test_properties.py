"""Random inputs against plain Python."""

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tallywood.functions import bands, numbers, parsing

MANY = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def python_value(kind, text):
    try:
        return kind(text)
    except ValueError:
        return None


NUMERALS = st.one_of(
    st.text("0123456789+-.eE xdfnai", max_size=6),
    st.sampled_from(["nan", "inf", "-Infinity", "1e5", "4.0f", "0x1", ".5", "5.", "+3", " 7 ", "\u00a08\t", "1d"]),
)


@MANY
@given(st.lists(NUMERALS, min_size=1, max_size=60))
def test_numerals_are_read_like_python_reads_them(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = df.select("i", parsing.to_long(F.col("t")), parsing.to_double(F.col("t"))).collect()
    for i, whole, real in found:
        assert whole == python_value(int, texts[i]), texts[i]
        assert repr(real) == repr(python_value(float, texts[i])), texts[i]


@MANY
@given(st.lists(st.one_of(
    st.floats(0, 1000), st.integers(0, 80000).map(lambda k: k / 8), st.integers(0, 10**6).map(lambda k: k / 1000),
), min_size=1, max_size=60))
def test_two_digits_like_python(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    for i, text, value in df.select("i", numbers.fixed_half_even(F.col("x")), numbers.round_half_even(F.col("x"))).collect():
        assert text == f"{values[i]:.2f}" and value == round(values[i], 2)


@MANY
@given(st.lists(st.integers(-5, 120), min_size=1, max_size=80))
def test_exactly_one_band_holds(spark, ages):
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    for table in (bands.FOUR_BANDS, bands.SEVEN_BANDS):
        conditions = bands.band_conditions(F.col("age"), table)
        held = F.filter(F.array(*[F.when(c, name) for name, c in conditions.items()]), lambda b: b.isNotNull())
        for names, band in rows(df.select(held, bands.band_of(F.col("age"), table))):
            assert names == [band]
