import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.vectors import cosine, dot, euclidean, unit


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first().y


def test_words(spark):
    assert one(spark, "Slate, Marble! Order 405.", T.words) == ["slate", "marble", "order", "405"]


@pytest.mark.parametrize("text", [" a ", "\x1f a\n", "a", "", "\x0b\x85 　"])
def test_strip_like_python(spark, text):
    assert one(spark, text, T.strip) == text.strip()
    assert one(spark, text, T.is_filled) == bool(text.strip())


def test_token_count(spark):
    assert one(spark, "It's 3 o_clock (été)!", T.token_count) == 9
    assert one(spark, None, T.token_count) == 0


def test_last_tokens(spark):
    assert one(spark, "one two, three.", lambda c: T.last_tokens(c, F.lit(3))) == ", three."
    assert one(spark, "one", lambda c: T.last_tokens(c, F.lit(9))) == "one"
    assert one(spark, "one two", lambda c: T.last_tokens(c, F.lit(0))) == ""


ODD_TEXTS = [
    "", " ", "\u3000\x1f", "one", "  Two,  three…\x85four ", "é_1 x²\t(İstanbul) 数 𝒜𝟙 \U0001f600\U0001f600", "a" * 90 + " b",
    "w " * 40, "-" * 50, " \n".join(f"word{i}, and{i}." for i in range(30)), "e\u0301 \u200b \ufeffx", "\x00a\x00",
]


def test_counts_words_and_ends_of_odd_texts_are_those_of_the_plain_patterns(spark):
    x = F.col("x")
    pieces = F.regexp_extract_all(x, F.lit(T.TOKEN_WITH_SPACE), F.lit(0))
    table = spark.createDataFrame([(t,) for t in ODD_TEXTS], "x string")
    ends = [(T.last_tokens(x, F.lit(n)), T.strip(F.array_join(F.slice(pieces, F.greatest(F.size(pieces) - n, F.lit(0)) + 1, n), ""))) for n in (0, 1, 2, 17, 60)]
    pairs = [
        (T.token_count(x), F.size(F.regexp_extract_all(x, F.lit(T.TOKEN), F.lit(0)))),
        (F.coalesce(F.split(T.spaced_words(x), " "), F.array().cast("array<string>")), T.words(x)),
        (T.is_filled(x), x.rlike(T.NON_SPACE)),
        *ends,
    ]
    for row in table.select(*[F.struct(a.alias("a"), b.alias("b")) for a, b in pairs]).collect():
        assert all(pair.a == pair.b for pair in row)


def test_no_string_is_made_for_each_token_that_is_counted(spark):
    """Counting took a third of the time of chunking."""
    counted = spark.createDataFrame([("a",)], "x string").select(T.token_count(F.col("x")))
    assert "regexp_extract_all" not in counted._jdf.queryExecution().optimizedPlan().toString()


def test_white_space_and_tags_in_table_cells(spark):
    html = "<table>\n<tr\nid='a'><td>a <b> c</b>\t</td><th>\u3000d\xa0&nbsp;e&amp;</th></tr><TR><td\n>x\n\ny</td></TR ></tr></table>"
    assert one(spark, html, T.html_table_to_markdown) == "| a c | d  e& |\n| --- | --- |\n| x y |  |"


@pytest.mark.parametrize(
    "filetype,expected",
    [(" JPG ", "image/jpeg"), ("image/webp", "image/webp"), ("bmp", "image/png"), (None, "image/png")],
)
def test_media_type(spark, filetype, expected):
    assert one(spark, filetype, T.media_type) == expected


@pytest.mark.parametrize(
    "html,expected",
    [
        (
            "<table><tr><th>Stone</th><th>Tons</th></tr><tr><td>Slate</td><td>12</td></tr></table>",
            "| Stone | Tons |\n| --- | --- |\n| Slate | 12 |",
        ),
        ("<table></table>", ""),
        (
            "<TABLE><TR class='a'><TD>a\n  b</TD></TR><tr></tr><tr><td><b>x</b>&nbsp;&amp;&lt;</td><td>y|z</td></tr></TABLE>",
            "| a b |  |\n| --- | --- |\n| x &&lt; | y|z |",
        ),
        ("just <b>bold</b> text", "just bold text"),
    ],
)
def test_table_markdown(spark, html, expected):
    assert one(spark, html, T.html_table_to_markdown) == expected


@pytest.mark.parametrize(
    "a,b,expected",
    [
        ([2, 3, 6], [2, 3, 6], 1.0),
        ([1, 0, 0], [0, 1, 0], 0.0),
        ([2, 3, 6], [-2, -3, -6], -1.0),
        ([0, 0, 0], [2, 3, 6], 0.0),
        ([2, 3, 6], [0, 0, 0], 0.0),
    ],
)
def test_cosine(spark, a, b, expected):
    row = spark.createDataFrame([([float(x) for x in a], [float(x) for x in b])], "a array<float>, b array<float>")
    assert row.select(cosine(F.col("a"), F.col("b"))).first()[0] == pytest.approx(expected)


def test_other_vector_functions(spark):
    row = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, b array<float>")
    a, b = F.col("a"), F.col("b")
    got = row.select(dot(a, a), euclidean(a, b), unit(a), unit(b)).first()
    assert (got[0], got[1]) == (25.0, 5.0)
    assert got[2] == pytest.approx([0.6, 0.8]) and got[3] == [0.0, 0.0]
