"""Main content by structure and recurrence on pages in sentences of their own; learnt slots; recall of short sets; re-cut buckets; schedules."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import content, mixing, nearest, repeats

NOUNS = "harbour lantern meadow copper violin orchard glacier pepper saddle compass thunder marble kettle walnut beacon ribbon anchor timber velvet puzzle".split()


def sentence(r):
    return " ".join(r.choice(NOUNS) for _ in range(r.randint(6, 14))).capitalize() + f", as {r.choice(NOUNS)} {r.randrange(9999)} showed {r.choice(NOUNS)}."


#: Frame lines of three sites, none of them in the test data; the first of each are notices between paragraphs, the last the footer.
FRAMES = {
    "en": (["This website stores cookies on your device.", "Share this article", "Article last checked by the editorial desk in week 12"], ["Subscribe to our newsletter", "Privacy Policy", "© 2024 Foo Corp"]),
    "de": (["Dieser Artikel wurde automatisch geprüft", "Hinweis der Redaktion: Angaben ohne Gewähr!"], ["Impressum | Kontakt", "Ein Angebot der Musterverlag GmbH"]),
    "fr": (["Publicité", "Lire aussi notre dossier spécial"], ["Mentions légales", "Tous droits réservés par la rédaction"]),
}


def made_pages(seed, pages=14):
    """(rows, own content lines by page)."""
    r, rows, hidden = random.Random(seed), [], {}
    for site, (notices, footer) in FRAMES.items():
        for i in range(pages):
            lines, frame = [f"* [Start](http://{site}.example.org/start)", f"* [Team](http://{site}.example.org/team)", ""], {1, 2}
            lines += [f"# {sentence(r)}", ""]
            for k in range(r.randint(4, 9)):
                if k == 2:
                    lines += ["## Details", ""]
                lines += [sentence(r) if r.random() < 0.7 else "- " + sentence(r) + "\n- " + sentence(r), ""]
                lines = "\n".join(lines).split("\n")
                if r.random() < 0.5:
                    frame.add(len(lines) + 1)
                    lines += [r.choice(notices), ""]
            lines += ["Kind regards,", sentence(r), "", "| a | b |", "|---|---|", f"| {r.randrange(10**6)} | {r.choice(NOUNS)} |", ""]
            lines += ["### More on this site", f"- [x](http://{site}.example.org/{r.randrange(99999)})", f"- [y](http://{site}.example.org/{r.randrange(99999)})", ""]
            frame |= set(range(len(lines) - 3, len(lines)))
            frame |= set(range(len(lines) + 1, len(lines) + 1 + len(footer)))
            lines += footer
            rows.append((f"{site}-{i:02d}", site, "\n".join(lines)))
            hidden[f"{site}-{i:02d}"] = {n for n in frame if lines[n - 1].strip()}
    return rows, hidden


def scored(spark, rows, hidden, **options):
    df = spark.createDataFrame(rows, "page_id string, tree_id string, markdown string")
    sites = spark.createDataFrame([(s, f"http://{s}.example.org") for s in FRAMES], "tree_id string, base_url string")
    got = {(r.page_id, r.line_no) for r in content.boilerplate_lines(df, sites, **options).collect()}
    want = {(p, n) for p, lines in hidden.items() for n in lines}
    return len(got & want) / len(want), len(got & want) / len(got), df, sites


def test_frames_of_unseen_sites_are_found_without_phrases(spark):
    rows, hidden = made_pages(3)
    recall, precision, df, sites = scored(spark, rows, hidden, phrases={})
    assert recall >= 0.95 and precision >= 0.95
    texts = {r.page_id: r.content for r in content.main_content(df, sites).collect()}
    assert len(texts) == len(rows) and not any("Foo Corp" in t or "Publicité" in t for t in texts.values()) and all("Kind regards," in t and "## Details" in t for t in texts.values())


def test_recurring_forms_by_join_equal_those_by_broadcast(spark, monkeypatch):
    rows, hidden = made_pages(4, 8)
    df = spark.createDataFrame(rows + rows[:3], "page_id string, tree_id string, markdown string")
    plain = {tuple(r) for r in content.boilerplate_lines(df).collect()}
    for most in (0, 7):
        monkeypatch.setattr(repeats, "BROADCAST_TEMPLATES", most)
        assert {tuple(r) for r in content.boilerplate_lines(df).collect()} == plain
    assert plain


def test_lines_of_copied_pages_and_long_notices(spark):
    r = random.Random(8)
    body = [sentence(r) for _ in range(30)]
    copies = [(f"c{i:03d}", "t", "# Same page\n\n" + "\n\n".join(x for k, x in enumerate(body) if k != i % 30)) for i in range(90)]
    notice = "We use cookies to improve. " + "and so on " * 60
    others = [(f"o{i}", "t", f"# {sentence(r)}\n\n{sentence(r)}\n\n{notice}\n\n{sentence(r)}") for i in range(8)]
    df = spark.createDataFrame(copies + others, "page_id string, tree_id string, markdown string").coalesce(1)
    got = {(x.page_id, x.line_no) for x in content.boilerplate_lines(df).collect()}
    assert got == {(f"o{i}", 5) for i in range(8)}


def test_tree_of_elements_and_sections():
    rules = content.PageRules()
    page = "# T\n<div hidden>\n## inside\ntext\n</div>\nback\n<section>\n### in section\nown\n</section>\n## next\n[a](#x)\nend"
    assert content.hidden_lines(page, rules) == [2, 3, 4, 5, 7, 10, 12]
    assert content.hidden_lines("x\n" * 3 + "<div>\n" * 3000 + "y", rules) == list(range(4, 3004))


# --- learnt slots


def test_slots_join_lines_that_differ_in_a_word(spark):
    names = "Anna Ben Carl Dora Emil Fred".split()
    rows = [(f"p{i}", "t", f"this long page was shared by {n}\nown text {NOUNS[i]} {NOUNS[-i - 1]} {NOUNS[i + 3]} stays here") for i, n in enumerate(names)]
    rows += [("q", "u", "this long page was shared by Gina"), ("n", None, None), ("e", "t", "")]
    df = spark.createDataFrame(rows, "page string, site string, text string").repartition(3)
    assert repeats.repeated_lines(df, "site", "page", "text").count() == 0
    for most in (0, None):
        assert {tuple(x) for x in repeats.repeated_lines(df, "site", "page", "text", slots=True, most=most).collect()} == {(f"p{i}", 1) for i in range(6)}
    assert [x.template.replace(repeats.SLOT, "*") for x in repeats.slot_templates(df, "site", "page", "text").collect()] == ["this long page was shared by *"]
    kept = {x.page: x.text for x in repeats.without_repeated_lines(df, "site", "page", "text", slots=True).collect()}
    assert kept["p0"].startswith("own text") and kept["q"] == "this long page was shared by Gina" and kept["n"] is None and kept["e"] == ""


def test_a_template_keeps_at_least_the_shared_tokens():
    t = repeats.Template("shared by anna on monday".split())
    assert t.learn("shared by ben on monday".split()) and t.tokens == ["shared", "by", None, "on", "monday"]
    assert not t.learn("moved to ben for ever".split()) and t.learn(["shared", "by", None, "on", "monday"])


# --- short sets


@pytest.mark.parametrize("size", [5, 6, 8, 12, 16, 20])
def test_recall_of_short_sets(size):
    r = np.random.default_rng(size)
    common = -(-size * 3 // 4)  # intersection over union of at least 0.6
    pairs, found = 1500, 0
    limit, long_limit = nearest.radius(nearest.SHORT_BITS), nearest.radius(nearest.LONG_BITS)
    for _ in range(pairs):
        hashes = r.integers(0, 1 << 63, 2 * size - common, dtype=np.uint64)
        (ka, sa), (kb, sb) = (nearest.sketch(np.sort(h), True) for h in (hashes[:size], hashes[size - common :]))
        bits = np.unpackbits(np.frombuffer(sa, np.uint8) ^ np.frombuffer(sb, np.uint8))
        found += bool((ka == kb).any()) and bits[: nearest.SHORT_BITS].sum() <= limit and bits.sum() <= long_limit
    assert found / pairs >= 0.999


def test_sets_around_the_border_have_both_sketches():
    assert nearest.sorts_of(64) == [True] and nearest.sorts_of(65) == [True, False] and nearest.sorts_of(106) == [True, False] and nearest.sorts_of(107) == [False]


def test_short_near_duplicates_equal_brute_force(spark):
    r = random.Random(5)
    rows = []
    for g in range(40):
        words = [f"w{r.randrange(9000)}" for _ in range(r.randint(9, 110))]
        rows += [(f"{g:02d}-{k}", " ".join(words[: len(words) - k * r.randint(0, 2)])) for k in range(3)]
    sets = {p: set(nearest.shingle_sets([t])[0].tolist()) for p, t in rows}
    ids = sorted(sets)
    want = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b]) and sets[a]}
    df = spark.createDataFrame(rows, "id string, text string")
    assert {tuple(x) for x in nearest.near_duplicate_pairs(df, "id", "text").collect()} == want and len(want) > 60


# --- schedules


def test_shortness_comes_from_the_inverted_demand(spark):
    docs = spark.createDataFrame([(i, s, "word " * 50) for i, s in enumerate(["a"] * 60 + ["b"] * 30)], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_weight double, max_repeats int")
    plan = spark.createDataFrame([("b", [(0.0, 2.0), (0.5, 2.0), (0.5001, 0.0), (1.0, 0.0)])], "source string, knots array<struct<at: double, factor: double>>")
    for schedules in (None, plan):
        report = {r.source: r for r in mixing.source_sizes(docs, targets, schedules)[1].collect()}
        assert report["a"].runs_out == 1.0 and report["b"].is_short and abs(report["b"].runs_out - (2 / 3 if schedules is None else 1 / 3)) < 1e-3
        assert [r.source for r in mixing.found_short(docs, targets, schedules).collect()] == ["b"]
    last = mixing.mix(docs, targets, plan)[0].where("source = 'b'").agg(F.max("position")).first()[0]
    assert last < 0.51
