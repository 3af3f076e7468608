import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leafmill.operators import cleaning as C
from leafmill.operators.bylines import take_byline

URL = "http://wiki.example.com"


def run(spark, step, text):
    df = spark.createDataFrame([(text, "x")], "t string, other string")
    return step(df, "t").first().t


def test_byline_over_lines_last_one_wins():
    a = f"* 由 [Author 1]({URL}/display/~a\n?from=b)创建, 最后修改于 [一月 01, 2020]({URL}/d/a)\n"
    b = f"由 [Author 2]({URL}/display/~b) 创建, 最后修改于 [二月 02, 2021]({URL}/d/b)\n"
    assert take_byline("head\n" + a + "mid\n" + b + "end") == ("head\nmid\nend", "Author 2", "二月 02, 2021")


def test_byline_longer_than_the_window_stays():
    text = f"由 [Author 1]({URL}/x\n" + "fold (x)\n" * 25 + f")创建, 最后修改于 [一月 01, 2020]({URL}/d)\n"
    assert take_byline(text) == (text, "", "")


def test_created_only_and_tight_forms():
    text = f"由 [Author 3]({URL}/~c)创建于[三月 03, 2022]({URL}/i)\nbody"
    assert take_byline(text) == ("body", "Author 3", "三月 03, 2022")
    tight = f"由[Author 4]({URL}/~d)创建,最后修改于[四月 04, 2023]({URL}/i)\nbody"
    rest, author, when = take_byline(tight)
    assert (rest.strip(), author, when) == ("body", "Author 4", "四月 04, 2023")


def test_split_byline_lines():
    text = f"由 [Author 5]({URL}/~e) 创建,\n最后修改于 [五月 05, 2024]({URL}/i) x\nbody"
    rest, author, when = take_byline(text)
    assert (rest.strip(), author, when) == ("body", "Author 5", "五月 05, 2024")


def test_navigation_cluster_needs_three_words():
    rules = (C.SKIP_MENU, C.RELATED_HINTS, C.NAV_WORDS)
    two = "* [空间](a)\n* [人员](b)\n* other\ntext\n"
    assert C.without_navigation(two, *rules) == two
    three = "* [空间](a)\n* x\n* [人员](b)\n* [注销](c)\n* kept\ntext\n"
    assert C.without_navigation(three, *rules) == "* kept\ntext\n"


def test_navigation_window_counts_lines_that_are_left():
    rules = (C.SKIP_MENU, C.RELATED_HINTS, C.NAV_WORDS)
    menu = "* [转至内容](#c)\n"
    head = "line\n" * (C.HEAD_LINES - 1)
    assert C.without_navigation(head + menu * 3 + "end\n", *rules) == head + "end\n"  # a run may go beyond the window
    late = "line\n" * C.HEAD_LINES + menu
    assert C.without_navigation(late, *rules) == late


def test_head_and_tail(spark):
    assert run(spark, C.cut_head, "menu\n　[转至元数据起始](#m)\n\nbody\n") == "body\n"
    assert run(spark, C.cut_head, "no mark") == "no mark"
    assert run(spark, C.cut_tail, "a\nb\n## 评论\nc 无标签") == "a\nb\n"
    assert run(spark, C.cut_tail, "无标签 at once") == ""
    assert run(spark, C.cut_tail, None) is None


def test_tree_sidebar(spark):
    assert run(spark, C.remove_tree_sidebar, "a\n##### 页面树结构\n* x\n重排页面（y）\n# T\nb") == "a\n\n# T\nb"
    assert run(spark, C.remove_tree_sidebar, "a\n##### 页面树结构\n* x\n# T\nb") == "a\n# T\nb"
    assert run(spark, C.remove_tree_sidebar, "a\n##### 页面树结构\n* x") == "a\n"


def test_titles_fold(spark):
    assert run(spark, C.dedupe_titles, "\n\n# My Page\nmy  page\n\ntext\n") == "# My Page\n\ntext"
    assert run(spark, C.dedupe_titles, "one\ntwo\n\ntext") == "one\ntwo\n\ntext"
    assert run(spark, C.dedupe_titles, "---\na: 1\n---\n## T\nT\n- x") == "---\na: 1\n---\n# T\n- x"
    assert run(spark, C.dedupe_titles, " \n ") == " \n "


def test_bare_files(spark):
    line = f"  {URL}/download/attachments/1/image1.png  \n{URL}/download/attachments/1/a%20b.pdf?x=1\n- {URL}/download/attachments/1/c.pdf"
    assert run(spark, C.link_bare_files, line) == f"![image1.png]({URL}/download/attachments/1/image1.png)\n* [a b.pdf]({URL}/download/attachments/1/a%20b.pdf?x=1)\n- {URL}/download/attachments/1/c.pdf"


def test_attachment_index(spark):
    page = f"{URL}/pages/viewpageattachments.action?pageId="
    df = spark.createDataFrame([(f"附件（3） {page}12\n[t(4)] {page}1 {page}12",), ("none",)], "raw string")
    got = [r.attachments_index for r in C.attachments_index(df, "raw").collect()]
    assert got == [f"## 附件与文件\n* [附件与文件管理（共 3 个）]({page}12)\n* [附件与文件管理（共 4 个）]({page}1)\n\n", ""]


def test_whole_chain_null_empty_long_and_extra_columns(spark):
    long_text = "# T\n" + "word " * 200_000
    rows = [(1, None, "k"), (2, "", "k"), (3, " \r\n\t", "k"), (4, long_text, "k"), (4, long_text, "k"), (5, "\n" * 40_000 + "x", "k")]
    df = spark.createDataFrame(rows, "id int, markdown string, author string")
    got = {r.id: r for r in C.clean_pages(df, "markdown").collect()}
    empty = '---\nauthor: ""\nlast_modified: ""\n---\n'
    assert got[1].cleaned == got[2].cleaned == got[3].cleaned == empty
    assert got[4].cleaned.startswith(empty + "\n# T\nword") or got[4].cleaned.startswith(empty + "# T\nword")
    assert got[5].cleaned.endswith("x\n")
    assert C.clean_pages(df.where("id < 0"), "markdown").count() == 0


@pytest.fixture(scope="module")
def squeezer(spark):
    def squeeze(texts):
        return [r.t for r in C.squeeze(spark.createDataFrame(pd.DataFrame({"t": texts})), "t").collect()]

    return squeeze


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet="a\n\r ", max_size=30), min_size=20, max_size=40))
def test_no_run_of_three_breaks_is_left(squeezer, texts):
    assert all("\n\n\n" not in t for t in squeezer(texts))
