from pyspark.sql import functions as F

from leafmill.operators.retrieval import hashed_embedding
from leafmill.plans import stages

NODES = [("t", "r", None, 0, "R", "page", None), ("t", "1", "r", 0, "A", "page", None), ("t", "2", "1", 0, "B", "page", None)]


def nodes(spark):
    return spark.createDataFrame(NODES, "tree_id string, id string, parent_id string, pos int, title string, node_type string, slug string")


def test_crawl_codes(spark, tmp_path):
    out = str(tmp_path)
    assert stages.crawl(nodes(spark), out, root_page_id="r", snapshot=nodes(spark)) == 0
    assert spark.read.parquet(f"{out}/trees").count() == 1 and spark.read.parquet(f"{out}/fetches").where("fast").count() == 1
    assert stages.crawl(nodes(spark), out, root_page_id="none") == 3
    assert stages.crawl(nodes(spark), out, resume_from_page_id="1", checkpoint_root_id="r") == 2


def test_export_places_pages_and_reports_failures(spark, tmp_path):
    attempts = spark.createDataFrame([("r", "t", 0, "R", "text r", ""), ("1", "t", 0, None, " ", "broken"), ("2", "t", 1, "B", "text b", "")], "page_id string, tree_id string, strategy_idx int, title string, markdown string, error string")
    roots = spark.createDataFrame([("t", "r")], "tree_id string, root_id string")
    assert stages.export(nodes(spark), roots, attempts, str(tmp_path)) == 1
    assert {r.rel_path for r in spark.read.parquet(f"{tmp_path}/pages").collect()} == {"t/R/R.md", "t/R/A_空/B/B.md"}
    assert spark.read.json(f"{tmp_path}/failures").first().relative_path == "R/A"
    existing = spark.createDataFrame([("t", "r", 5)], "tree_id string, id string, size long")
    assert stages.export(nodes(spark), roots, attempts.where("page_id <> '1'"), str(tmp_path / "b"), resume=True, existing=existing, max_fetch_strategies=9) == 1
    assert spark.read.parquet(f"{tmp_path}/b/outcome").first().skipped == 1


def test_convert_clean_ingest_chat(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a.txt", "b.doc", "c.zip", "d.mp3"):
        (tmp_path / "in" / name).write_text(f"about {name}\n|x|y|")
    folder, out = f"file:{tmp_path}/in", f"file:{tmp_path}/out"
    convert = lambda **o: stages.convert(spark, o.pop("folder", folder), out, converter=lambda n, b: b.decode(), date="2025-01-01", **o)
    assert convert(key="") == 3 and convert(key="k", folder=f"{folder}/none") == 2 and convert(key="k") == 1
    pages = spark.read.parquet(f"{out}/pages")
    assert {r.rel_path for r in pages.collect()} == {"a.md", "b.md"} and pages.where(F.col("content").contains("| x | y |")).count() == 2
    assert spark.read.json(f"{out}/failure_log").first().source_file == "c.zip"
    (tmp_path / "md").mkdir()
    (tmp_path / "md" / "x.md").write_text("# X\nbody\n无标签\nrest")
    assert stages.clean(spark, f"file:{tmp_path}/md", f"{out}/clean") == 0 and stages.clean(spark, f"file:{tmp_path}/nowhere", out) == 2
    assert "rest" not in spark.read.parquet(f"{out}/clean/pages").first().content
    assert stages.ingest(pages, out, embed=hashed_embedding) == 0
    lines = spark.createDataFrame([(1, "about a.txt"), (2, "exit"), (3, "never")], "order long, line string")
    assert stages.chat(lines, spark.read.parquet(f"{out}/chunks"), out, complete=lambda q, c: f"{q}: {c[:200]}", k=1) == 0
    answers = spark.read.parquet(f"{out}/answers").collect()
    assert len(answers) == 1 and "about a.txt" in answers[0].answer
    assert stages.chat(lines.where("order = 2"), spark.read.parquet(f"{out}/chunks"), out, complete=lambda q, c: "") == 3


def wiki(title_status=200):
    import json

    child = lambda *ids: (200, json.dumps({"results": [{"id": i, "title": f"Title {i}"} for i in ids]}))
    return {"/content/r": (title_status, json.dumps({"title": "Root"})), "/content/r/child/page": child("1", "2"), "/content/1/child/page": child("3", "r"), "/content/2/child/page": child(), "/content/3/child/page": child()}


def test_crawl_of_a_site_through_a_backend(spark, tmp_path):
    from leafmill.sources.connectors import Fixture

    answers = wiki()
    backend_of = lambda found: Fixture({(path, 0): answer for path, answer in found.items()})
    crawl = lambda out, make=lambda: backend_of(answers), **o: stages.crawl_site(spark, make, str(tmp_path / out), tree_id="t", pause=(0, 0), **{"root_page_id": "r"} | o)
    assert crawl("a", checkpoint_every=2) == 0
    assert spark.read.parquet(f"{tmp_path}/a/snapshot").count() == 4
    text = spark.read.parquet(f"{tmp_path}/a/trees").first().json
    assert text.count('"id"') == 4 and "Title 3" in text
    assert crawl("b", max_depth=1) == 0 and spark.read.parquet(f"{tmp_path}/b/trees").first().json.count('"id"') == 3
    # below the limit the snapshot's children stay, above it the listing counts
    snapshot = nodes(spark).unionByName(spark.createDataFrame([("t", "9", "1", 0, "Old", "page", None), ("t", "8", "r", 5, "Gone", "page", None)], nodes(spark).schema))
    assert crawl("c", max_depth=1, snapshot=snapshot) == 0
    text = spark.read.parquet(f"{tmp_path}/c/trees").first().json
    assert "Old" in text and "Gone" not in text
    assert crawl("d", root_page_id=None) == 2 and crawl("e", root_page_id="none") == 3
    broken = {**answers, "/content/2/child/page": (500, "down")}
    assert crawl("f", lambda: backend_of(broken)) == 4 and spark.read.parquet(f"{tmp_path}/f/snapshot").count() == 3

    def interrupted():
        raise KeyboardInterrupt

    assert crawl("g", interrupted) == 130


def test_credentials_are_renewed_once():
    from leafmill.sources.connectors import Credentials, Fixture, tolerant_json, with_login

    made = []

    def make(credentials):
        made.append(credentials.cookie)
        return Fixture({("/x", 0): (200, "{}") if credentials.cookie == "new" else (401, "")})

    assert tolerant_json(with_login(make, Credentials(cookie="old")), "/x") == (401, None)
    backend = with_login(make, Credentials(cookie="old"), lambda c: Credentials(c.user, c.password, "new"))
    assert tolerant_json(backend, "/x") == (200, {}) and made == ["old", "old", "new"] and tolerant_json(backend, "/none") == (404, None)


def test_export_keeps_its_state_and_goes_on(spark, tmp_path):
    attempts = spark.createDataFrame([(i, "t", 0, i, f"text {i}", "") for i in ("r", "1", "2")], "page_id string, tree_id string, strategy_idx int, title string, markdown string, error string")
    roots = spark.createDataFrame([("t", "r")], "tree_id string, root_id string")
    assert stages.export(nodes(spark), roots, attempts, str(tmp_path), as_files=str(tmp_path / "files")) == 0
    assert (tmp_path / "files/t/R/A/A.md").read_text() == "text 1"
    states = spark.read.parquet(f"{tmp_path}/state").orderBy("saved_at").collect()
    assert [s.reason for s in states] == ["init", "page_saved", "tree_done", "finished"] and states[-1].status == "completed" and list(states[-1].trees_completed) == ["t"] and states[-1].last_page.page_id == "2"
    assert stages.export(nodes(spark), roots, attempts, str(tmp_path), resume=True) == 0  # the completed tree is left out
    assert spark.read.parquet(f"{tmp_path}/state").count() == 4
    assert stages.export(nodes(spark).where("id = 'x'"), roots, attempts, str(tmp_path / "b")) == 2
    assert stages.export(nodes(spark), roots, attempts.drop("markdown"), str(tmp_path / "c")) == 4
    assert spark.read.parquet(f"{tmp_path}/c/state").where("status = 'interrupted'").count() == 1 and "status=interrupted" in spark.read.text(f"{tmp_path}/c/interrupt_log").first().value


def test_clean_isolates_files_and_fetches_attachments(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    link = "http://wiki.example.com/download/attachments/7/a.png"
    (tmp_path / "in" / "a.md").write_text(f"# A\n{link}\nbody\n")
    (tmp_path / "in" / "b.md").write_text("# B\nhttp://wiki.example.com/download/attachments/7/bad.png\n")
    folder = f"file:{tmp_path}/in"
    assert stages.clean(spark, folder, f"{tmp_path}/o1") == 0

    def fetch(url):
        if "bad" in url:
            raise OSError("refused")
        return b"bytes"

    assert stages.clean(spark, folder, f"{tmp_path}/o2", fetch=fetch, attachment_dir=str(tmp_path / "att")) == 1
    assert (tmp_path / "att/a.md/a.png").read_bytes() == b"bytes" and not list((tmp_path / "att").rglob("*.part")) and not (tmp_path / "att/b.md/bad.png").exists()
    assert {(r.doc, r.success, r.failed) for r in spark.read.parquet(f"{tmp_path}/o2/attachments").collect()} == {("a.md", 1, 0), ("b.md", 0, 1)}
    (tmp_path / "att/a.md/a.png").write_bytes(b"kept")
    (tmp_path / "in" / "b.md").write_text("# B")
    assert stages.clean(spark, folder, f"{tmp_path}/o3", fetch=fetch, attachment_dir=str(tmp_path / "att")) == 0 and (tmp_path / "att/a.md/a.png").read_bytes() == b"kept"
    monkeypatch.setattr(stages, "MOST_BYTES", 10)
    assert stages.clean(spark, folder, f"{tmp_path}/o4") == 1
    assert spark.read.json(f"{tmp_path}/o4/failures").first().rel_path == "a.md" and spark.read.parquet(f"{tmp_path}/o4/pages").count() == 1


def test_a_text_that_fails_fails_alone(monkeypatch):
    from leafmill.operators import bylines

    monkeypatch.setattr(bylines, "take_byline", lambda t: 1 / 0 if t == "bad" else (t, "", ""))
    assert [bylines._guarded(t) for t in ("good", "bad", None)] == [("good", "", "", None), ("bad", "", "", "division by zero"), (None, "", "", None)]


def test_convert_upgrades_legacy_files_and_keeps_colliding_outputs_apart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a.docx", "a.pdf", "b.doc"):
        (tmp_path / "in" / name).write_text(name)
    seen = lambda n, b: f"{n}:{b.decode()}"
    assert stages.convert(spark, f"file:{tmp_path}/in", f"{tmp_path}/out", converter=seen, key="k", date="2025-01-01", models=["only"], upgrade=lambda n, b: (n + "x", b + b"!")) == 0
    pages = {r.rel_path: r.content for r in spark.read.parquet(f"{tmp_path}/out/pages").collect()}
    assert set(pages) == {"a.md", "a_pdf.md", "b.md"} and "b.docx:b.doc!" in pages["b.md"] and all('used_llm_model: "only"' in t for t in pages.values())
    results = {r.rel_path: r for r in spark.read.parquet(f"{tmp_path}/out/results").collect()}
    assert results["a.pdf"].collides and not results["a.docx"].collides and results["b.doc"].elapsed_sec >= 0
