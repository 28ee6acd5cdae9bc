from pyspark.sql import functions as F

from newsloom.functions import pages
from newsloom.session import ARROW_BYTES, utc_session



def test_main_text(one):
    html = (
        "<html><head><title>T</title></head><body><nav>menu</nav><!-- <p>no</p> -->"
        "<script>var a='</p>';</script><div>around</div><article><h1>Head</h1>"
        "<p>One <b>bold</b>\n  line&nbsp;&amp; more</p><ul><li>a<li>b</ul>"
        "<aside>ad</aside></article><footer>&copy;</footer></body></html>"
    )
    assert one([html], pages.page_text(F.col("v"))) == ["Head\nOne bold line & more\na\nb"]


def test_region_fallbacks(one):
    texts = one(
        [
            "<main><p>m</p></main><p>rest</p>",
            "<body><p>b &lt;i&gt;</p><form>f</form></body>",
            "plain",
            "<article></article>only this",
            "<article>a</article> and <article>b</article>",
            "<nav>x</nav>",
            "",
            None,
        ],
        pages.page_text(F.col("v")),
    )
    assert texts == ["m", "b <i>", "plain", "only this", "a\nand\nb", None, None, None]


def test_unclosed_marks_do_not_swallow_the_text(one):
    assert one(["<p>a<br>b<p>c < d &am e"], pages.page_text(F.col("v"))) == ["a\nb\nc < d &am e"]


def test_title_and_language(one):
    rows = [
        "<html class='x' lang=\"pt-BR\"><title> A &amp;\n B </title>",
        '<meta property="og:title" content="Social"><title>Plain</title>',
        "<html><title></title>",
        None,
    ]
    assert one(rows, pages.page_title(F.col("v"))) == ["A & B", "Social", None, None]
    assert one(rows, pages.page_language(F.col("v"))) == ["pt-BR", None, None, None]


def test_status_counts_stripped_characters(one):
    rows = ["x" * 200, "x" * 199, " " * 300, None]
    assert one(rows, pages.text_status(F.col("v"))) == ["ok"] + ["extract-weak"] * 3


def test_batches_of_long_pages_are_bounded(spark):
    @F.pandas_udf("long")
    def together(texts):
        return texts.str.len().sum() + 0 * texts.str.len()

    rows = utc_session(spark).range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    assert rows.select(F.max(together("text"))).first()[0] <= ARROW_BYTES + 20_000
