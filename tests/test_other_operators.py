import json

import pytest
from pyspark.sql import functions as F

from leafmill.functions import text as T
from leafmill.operators import attachments as A
from leafmill.operators import conversion as V
from leafmill.operators import html as H
from leafmill.operators import retrieval as G
from leafmill.operators import runs as R
from leafmill.operators.ranking import ranked
from leafmill.sources import connectors as N
from leafmill.sources import files, settings, sinks
from leafmill.streaming.incremental import add_cleaned, clean_arrivals

URL = "http://wiki.example.com"


def one(spark, column, **values):
    return spark.range(1).select(column(**{k: F.lit(v) for k, v in values.items()}).alias("v")).first().v


def test_names_and_paths(spark):
    assert one(spark, lambda x: T.file_name(x), x='　a/b:c*?"<>|\\ ') == "a_b_c_______"
    assert one(spark, lambda x: T.file_name(x), x=" ") == "untitled"
    assert one(spark, lambda x: T.file_name(x), x=None) == "untitled"
    assert one(spark, lambda x: T.markdown_path(x), x="a/.hidden") == "a/.hidden.md"
    assert one(spark, lambda x: T.markdown_path(x), x="a.b/c.tar.gz") == "a.b/c.tar.md"
    assert one(spark, lambda x: T.url_file_name(x), x=f"{URL}/a/b%20c+d%zz.png?x=1") == "b c+d%zz.png"
    assert one(spark, lambda x: T.url_file_name(x), x=f"{URL}/a/%E4%BD%A0+.png#f") == "你+.png"
    assert one(spark, lambda x: T.url_file_name(x), x=URL) == "attachment.bin"
    assert one(spark, lambda x: T.attachment_count(x), x="附件（2） t(3)附件") == "3"
    assert one(spark, lambda x: T.yaml_scalar(x), x='a: "b" \\') == '"a: \\"b\\" \\\\"'


def test_site_bases_and_ids(spark):
    text = f"{URL}/x/pages/view?pageId=10 {URL}/download/attachments/1/a.png {URL}/x/pages/view?pageId=9&pageId=010"
    assert one(spark, lambda x: T.site_bases(x), x=text) == [f"{URL}/x", URL]
    assert one(spark, lambda x: T.page_ids(x), x=text) == ["9", "010", "10"] or one(spark, lambda x: T.page_ids(x), x=text) == ["9", "10", "010"]
    assert one(spark, lambda x: T.site_bases(x, "http://d.example.com/"), x="none") == ["http://d.example.com"]
    assert one(spark, lambda x: T.site_bases(x), x="none") == []


def test_table_lines(spark):
    text = "| a | b |\n|:--|--: |\n||x| |\n```|no\n plain  \n| | - |"
    assert one(spark, lambda x: V.table_lines(x), x=text) == "| a | b |\n| :-- | --: |\n| x |  |\n```|no\n plain\n|  | - |"
    assert one(spark, lambda x: V.table_lines(x), x="|:- -|--|") == "| :-- | -- |"
    assert one(spark, lambda x: V.table_lines(x), x="") == ""


def test_converter_isolates_failures(spark):
    rows = spark.createDataFrame([("a.DOCX", b"1"), ("b.mp4", b"2"), ("c.zip", b"3"), ("d.pdf", b"boom"), ("e", b"")], "path string, content binary")

    def convert(name, body):
        if body == b"boom":
            raise RuntimeError("broken")
        return f"{name}:{len(body)}"

    got = {r.path: (r.status, r.text, r.error) for r in V.converted(V.routed(rows, "path"), "path", "content", convert).collect()}
    assert got == {"a.DOCX": ("ok", "a.DOCX:1", None), "b.mp4": ("skipped", None, None), "c.zip": ("failed", None, "unsupported file type"), "d.pdf": ("failed", None, "broken"), "e": ("failed", None, "unsupported file type")}


def test_html():
    page = '<h1>T</h1><p>a <b>bold</b> <a href="/x">l</a><p>next<ul><li>one<ul><li>two</ul><li>three</ul><table><tr><td colspan="2">k</table><table><tr><th>h<tr><td>v|w</table><pre>c\nd</pre><script>no</script><img src="//host/i.png">'
    md = H.page_markdown(page, URL + "/")
    assert md == f'# T\n\na **bold** [l]({URL}/x)\n\nnext\n\n* one\n  * two\n* three\n\n<table><tr><td colspan="2">k</td></tr></table>\n\n| h |\n| --- |\n| v\\|w |\n\n```\nc\nd\n```\n\n![]({URL}//host/i.png)'
    assert H.page_markdown("") == "" and H.page_markdown("<p>open") == "open"
    nested = '<table><tr><td rowspan="2"><table><tr><td>in</td></tr></table></td></tr></table>'
    assert "<td>in</td>" in H.page_markdown(nested)


def test_ranked_is_dense_over_partitions(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("g", F.col("id") % 3).withColumn("rank", F.lit("clash"))
    got = ranked(df.drop("rank"), [-F.col("id")], ["g"])
    assert got.groupBy("g").agg(F.min("rank").alias("a"), F.max("rank").alias("b"), F.countDistinct("rank").alias("c")).orderBy("g").collect() == [(0, 1, 334, 334), (1, 1, 333, 333), (2, 1, 333, 333)]


def test_attachment_plan(spark):
    docs = spark.createDataFrame([("d", f"{URL}/pages/v?pageId=1 {URL}/download/attachments/1/a.png {URL}/download/attachments/2/a.png"), ("n", None)], "doc string, raw string")
    listings = spark.createDataFrame([(URL, "1", "att7", " a?x ", "/download/attachments/1/a.png"), (URL, "1", "", "", "download/b%20c"), (URL, "1", "z", "t", "")], "site string, page_id string, att_id string, title string, download string")
    got = sorted((r.url, r.source, r.file_name) for r in A.attachment_plan(docs, "doc", "raw", listings).collect())
    assert got == [(f"{URL}/download/attachments/1/a.png", "rest", "att7_a"), (f"{URL}/download/attachments/2/a.png", "direct", "a.png"), (f"{URL}/download/b%20c", "rest", "b c")]


def test_fetch_fallback_and_states(spark):
    rows = [("1", "t", 0, "A", "　\n", "e0"), ("1", "t", 1, "B", "text", ""), ("1", "t", 1, "B", "text", ""), ("2", "t", 0, None, None, "e0"), ("2", "t", 1, None, " ", "e1"), ("3", "t", 0, None, "x", None), (None, "t", 0, None, "x", None)]
    df = spark.createDataFrame(rows, "page_id string, tree_id string, strategy_idx int, title string, markdown string, error string")
    got = {r.page_id: (r.title, r.markdown, r.error) for r in R.fetch_fallback(df).collect()}
    assert got == {"1": ("B", "text", ""), "2": ("page_2", None, "e1"), "3": ("page_3", "x", "")}
    assert R.failure_listing(spark.createDataFrame([], "page_id string, title string, relative_path string, error string")).count() == 0


def test_cosine_top_k_against_brute_force(spark):
    import numpy as np

    r = np.random.default_rng(1)
    x = r.normal(size=(300, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 8), (902, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    q = df.where("vec_id % 50 = 0 AND vec_id < 300").selectExpr("vec_id AS query_id", "v AS vector")
    got = {}
    for row in G.cosine_top_k(df, "vec_id", "v", q, 5).collect():
        got.setdefault(row.query_id, {})[row.rank] = row.vec_id
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(0, 300, 50):
        s = n @ n[i]
        s[i] = -9
        assert [got[i][k] for k in range(1, 6)] == np.argsort(-s, kind="stable")[:5].tolist()
    assert G.cosine_top_k(df.where("vec_id < 0"), "vec_id", "v", q, 5).count() == 0


def test_chunks_questions_embedding(spark):
    df = spark.createDataFrame([(1, "x" * 2500), (2, ""), (3, None)], "doc_id long, text string")
    assert [(r.chunk_no, len(r.chunk)) for r in G.chunks(df, "doc_id", "text").orderBy("chunk_no").collect()] == [(0, 1200), (1, 1200), (2, 300)]
    lines = spark.createDataFrame([(1, " a "), (2, ""), (3, None), (4, "Quit"), (5, "b")], "k long, line string")
    assert [r.question for r in G.questions(lines, "k", "line").collect()] == ["a"]
    assert len(G.embedded(df, "text", G.hashed_embedding).first().embedding) == 64
    with pytest.raises(ValueError):
        G.checked_key("key", " ")
    assert G.parser_for({"plaintext": len}, None) is len


def test_connectors(spark):
    page = lambda start, n, link: {"results": [{"id": start + i, "title": f"p{start + i}", "type": "page"} for i in range(n)], "_links": {"next": link} if link else {}}
    answers = [{"path": "/c/7", "start": 0, "body": page(0, 2, "/c/7?start=2")}, {"path": "/c/7", "start": 2, "body": page(2, 2, "/c/7?limit=2")}, {"path": "/c/7", "start": 4, "body": page(4, 2, None)}]
    spark.dataSource.register(N.WikiListing)
    df = spark.read.format("wiki_listing").options(ids="7", path="/c/{id}", limit="2", answers=json.dumps(answers)).load()
    assert [(r.page_no, r.pos, r.id) for r in df.orderBy("page_no", "pos").collect()] == [(0, 0, "0"), (0, 1, "1"), (1, 0, "2"), (1, 1, "3"), (2, 0, "4"), (2, 1, "5")]
    back = N.Fixture({("/a", 0): (200, json.dumps(page(0, 2, None))), ("/a", 2): (200, json.dumps(page(2, 1, None))), ("/t", 0): (200, "no json"), ("/e", 0): (503, "x" * 900)})
    assert len(list(N.counted_pages(back, "/a", 2))) == 3
    assert N.try_json(back, "/t") is None and N.try_json(back, "/none") is None
    with pytest.raises(N.RestError) as e:
        N.get_json(back, "/e")
    assert len(str(e.value)) == len("HTTP 503: ") + 500
    waits = []
    tries = iter([(("t"), " "), ("t", "text")])
    assert N.fetch_page(lambda p, k: next(tries), "1", 2, waits.append) == ("t", "text", "", 1) and waits == [1.5]
    assert N.fetch_page(lambda p, k: ("t", ""), "1", 9, waits.append)[2:] == ("blank Markdown", 1)


def test_files_settings_and_sinks(spark, tmp_path):
    for name, body in {"b.json": "{}", "A.json": "{}", "_x.json": "{}", "sub/n.md": b"\xffa\r\n", "r.MD": "x", "s.docx": "y"}.items():
        p = tmp_path / "in" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(body if isinstance(body, bytes) else body.encode())
    root = f"file:{tmp_path}/in"
    assert [r.basename for r in files.tree_files(spark, root).orderBy("place").collect()] == ["A.json", "b.json"]
    assert [r.text for r in files.markdown_files(spark, root).collect()] == ["�a\r\n"]
    assert {r.rel_path for r in files.typed_files(spark, root, ["md", "docx"]).collect()} == {"sub/n.md", "r.MD", "s.docx"}
    assert [p.rsplit("/", 1)[1] for p in files.resolve_trees(spark, root, "/none", "/none", "/none")] == ["A.json", "b.json"]
    assert files.resolve_trees(spark, "/missing", "/none", f"{root}/b.json", "/none") == [f"{root}/b.json"]
    assert settings.setting(["A", "B"], "d", {"A": " ", "B": " x "}) == "x" and settings.setting(["P"], env={"P": " p "}, strip=False) == " p "
    assert settings.base_url(["U"], env={"U": "http://h//"}) == "http://h"
    sinks.write_snapshot("one", str(tmp_path / "snap" / "s.json"))
    assert (tmp_path / "snap" / "s.json").read_text() == "one"
    assert [n for n in range(45) if sinks.snapshot_due(n)] == [20, 40] and not sinks.snapshot_due(20, 0)
    pages = spark.createDataFrame([("a/b.md", "x\r\ny"), ("c.md", None)], "rel_path string, content string")
    sinks.write_page_files(pages, str(tmp_path / "out"))
    assert (tmp_path / "out" / "a" / "b.md").read_bytes() == b"x\ny" and (tmp_path / "out" / "c.md").read_bytes() == b""
    assert not sinks.write_failures(pages.where("rel_path = ''"), str(tmp_path / "failures"))


def test_stream_cleans_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.md").write_text("# A\ntext\n## 评论\nx")
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    for _ in range(2):
        clean_arrivals(spark, str(tmp_path / "in"), table, checkpoint).awaitTermination(120)
        (tmp_path / "in" / "b.md").write_text("# B")
    rows = spark.read.parquet(table)
    assert rows.count() == 2 and "评论" not in "".join(r.cleaned for r in rows.collect())
    add_cleaned(rows.selectExpr("path", "'again' AS text"), table)
    assert spark.read.parquet(table).count() == 2


def test_changed_files_are_cleaned_again(spark, tmp_path):
    from leafmill.streaming.incremental import latest_cleaned

    make = lambda rows: spark.createDataFrame(rows, "path string, mtime timestamp, text string")
    at = lambda d: __import__("datetime").datetime(2024, 1, d)
    table = str(tmp_path / "t")
    for _ in range(2):  # a repeated batch replaces itself
        add_cleaned(make([("a", at(1), "one"), ("b", at(1), "two")]), table, 0)
    add_cleaned(make([("a", at(2), "changed")]), table, 1)
    assert spark.read.parquet(table).count() == 3
    assert {r.path: "changed" in r.cleaned for r in latest_cleaned(spark, table).collect()} == {"a": True, "b": False}
    add_cleaned(make([("b", at(1), "again"), ("c", at(1), "new")]), table)
    assert spark.read.parquet(table).count() == 4


def test_private_use_characters_and_escapes_stay(spark):
    from leafmill.functions import text as X
    from leafmill.operators.html import absolute_links

    df = spark.createDataFrame([("ab\r\n\n\r\nc", "x%zzy%20z%E4%BD%A0%", '<a href="/x">/</a>')], "t string, u string, h string")
    got = df.select(X.squeezed_keeping_crlf(F.col("t")).alias("t"), X.percent_decoded(F.col("u")).alias("u"), absolute_links(F.col("h"), F.lit("http://h/$1/")).alias("h")).first()
    assert (got.t, got.u, got.h) == ("ab\n\nc", "x%zzy z你%", '<a href="http://h/$1/x">/</a>')


def test_queries_in_blocks_rank_alike(spark, monkeypatch):
    from leafmill.operators import retrieval as G

    vectors = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i % 5)]) for i in range(40)], "id long, v array<double>")
    asked = vectors.where("id % 4 = 0").selectExpr("id AS query_id", "v AS vector")
    plain = {tuple(r) for r in G.cosine_top_k(vectors, "id", "v", asked, 3).collect()}
    monkeypatch.setattr(G, "QUERY_BLOCK", 3)
    assert {tuple(r) for r in G.cosine_top_k(vectors, "id", "v", asked, 3).collect()} == plain and len(plain) == 30
