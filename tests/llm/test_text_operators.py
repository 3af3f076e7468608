import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from leafmill.llm import content, encoding, mixing, nearest, personal, repeats, spans

PAGE = "page_id string, strategy_idx int, title string, markdown string, tree_id string, line_no int, kind string"


def pages(spark, rows):
    return spark.createDataFrame([(p, 0, None, m, t, 7, None) for p, m, t in rows], PAGE)


# --- encoding


@pytest.fixture(scope="module")
def reference():
    import public_tokenizers as P

    ranks = encoding.load_ranks(P.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_public_library(reference):
    enc = encoding.encoder(encoding.default_vocabulary())
    r = random.Random(1)
    alphabets = ["ab", "abc ", "aeiounrst", "的一是在a", "äöü é", "0123456789", "=-_*#", "ABCdefgh ", "😀☰×​", " \t\n\r　"]
    texts = ["".join(r.choice(r.choice(alphabets)) for _ in range(r.randint(0, 80))) for _ in range(1500)]
    texts += ["".join(r.choice(a) for _ in range(r.randint(1, 60))) for a in alphabets for _ in range(60)]
    texts += ["<|endoftext|> x", "a" * 3000, "=" * 5000, "ab" * 4000, "的" * 3000, "\ud83d".encode("utf-8", "replace").decode()]
    assert [enc.encode(t) for t in texts] == [reference.encode_ordinary(t) for t in texts]


def test_stream_emits_early_and_keeps_a_bounded_window():
    t = encoding.Transducer(encoding.load_ranks(encoding.default_vocabulary()))
    taken = []

    def endless():
        for i in range(100_000):
            taken.append(i)
            yield ord("a")

    next(t.stream(endless()))
    assert len(taken) <= 8 * t.lookahead


def test_encoding_rows_and_round_trip(spark, reference):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "x" * 200_000), (4, "twice"), (None, "id"), (5, "a\r\n\tü🙂" * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash"))
    got = encoding.encode_texts(df, "doc_id", "text")
    assert got.columns == ["doc_id", "ids"] and dict(got.dtypes)["ids"] == "array<int>"
    assert sorted((repr(r.doc_id), list(r.ids)) for r in got.collect()) == sorted((repr(i), reference.encode_ordinary(t) if t else []) for i, t in rows)
    assert sorted(map(repr, (r.text for r in encoding.decode_ids(got, "doc_id", "ids").collect()))) == sorted(repr(t or "") for _, t in rows)
    assert encoding.encode_texts(df.where("doc_id < 0"), "doc_id", "text").count() == 0


def test_utf8_machine_equals_the_decoder():
    r = random.Random(2)
    for _ in range(300):
        data = bytes(r.choice([0x41, 0xC3, 0xA4, 0xE4, 0xBD, 0xA0, 0xF0, 0x9F, 0x99, 0x82, 0xFF, 0xED]) for _ in range(r.randint(0, 12)))
        m = encoding.Utf8Machine()
        assert "".join(m.feed(bytes([b])) for b in data) + m.end() == data.decode("utf-8", "replace")


# --- mixing


def test_mix_reaches_shares_and_reports_short_sources(spark):
    rows = [(i, "big", "word " * 50) for i in range(900)] + [(1000 + i, "small", "word " * 50) for i in range(40)] + [(2000, None, "x"), (2001, "small", None), (2002, "small", ""), (2003, "other", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("n_tokens", F.lit(1))
    targets = spark.createDataFrame([("big", 0.5, 3), ("small", 0.1, 4), ("tiny", 0.3, 8), ("zero", 0.0, 1), (None, 0.1, None)], "source string, target_weight double, max_repeats int")
    copies, report = mixing.mix(docs, targets)
    got = {r.source: r for r in mixing.shares(copies, report).collect()}
    assert got["tiny"].is_short and got["tiny"].size == 0 and not got["big"].is_short and not got["zero"].is_short and not got["small"].is_short
    assert got["small"].repeats == 3 and abs(got["small"].used_tokens - 0.1 * got["small"].budget) <= 51
    assert abs(got["big"].used_tokens - 0.5 * got["big"].budget) <= 51
    p = [r.position for r in copies.collect()]
    assert p == sorted(p) and 0 <= p[0] and p[-1] < 1
    assert sorted(r.source for r in mixing.found_short(docs, targets).collect()) == ["tiny"]
    assert mixing.found_short(docs.where("doc_id < 0"), targets).count() == 0


def test_schedule_moves_a_source_to_the_end(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], "word " * 20) for i in range(400)], "doc_id long, source string, text string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_weight double, max_repeats int")
    copies, _ = mixing.mix(docs, targets, {"b": [(0.0, 0.0), (0.5, 0.0), (1.0, 1.0)]})
    low = {r.source: r.m for r in copies.groupBy("source").agg(F.min("position").alias("m")).collect()}
    assert low["a"] == 0 and low["b"] >= 0.5
    with pytest.raises(ValueError):
        mixing.normal_schedule([(0.0, 1.0)])


# --- repeated lines


def brute_repeats(rows, min_pages=5):
    seen = {}
    for p, m, t in rows:
        if m is not None and p is not None:
            for line in repeats.compared_lines(m):
                if repeats.is_long(line):
                    seen.setdefault((t, line), set()).add(p)
    return {(p, n) for p, m, t in rows if m is not None and p is not None for n, line in enumerate(repeats.compared_lines(m), 1) if len(seen.get((t, line), ())) >= min_pages}


def test_repeated_lines(spark, monkeypatch):
    rows = [(f"p{i}", f"Legal notice {i} for　all\nown text of page {chr(97 + i) * 12}\nshort\n  LEGAL  notice 7 for all \r", "t1") for i in range(6)]
    rows += [(f"q{i}", "only four pages have this line\n版权所有 一二三四五六七八九十", None) for i in range(4)] + [("q9", "版权所有 一二三四五六七八九十", None), ("n", None, "t1"), ("e", "", "t1"), (None, "x", "t1"), rows[0], rows[0]]
    df = pages(spark, rows)
    want = brute_repeats(rows)
    got = repeats.repeated_lines(df, "tree_id", "page_id", "markdown")
    assert {(r.page, r.line_no) for r in got.collect()} == want and got.count() == len(want)
    monkeypatch.setattr(repeats, "TREE_FILLS", 3)
    for most in (0, 1, None):
        assert {(r.page, r.line_no) for r in repeats.repeated_lines(df, "tree_id", "page_id", "markdown", most=most).collect()} == want
    clean = {r.page_id: r.markdown for r in repeats.without_repeated_lines(df, "tree_id", "page_id", "markdown").collect() if r.page_id}
    assert clean["p1"] == "own text of page bbbbbbbbbbbb\nshort" and clean["n"] is None and clean["e"] == ""
    assert repeats.repeated_lines(df.where("page_id = ''"), "tree_id", "page_id", "markdown").count() == 0


# --- main content


def test_content_rules(spark):
    site = "http://wiki-a.example.com/x"
    page = f"""<div class="nav">
* [空间]({site}/spaces)
Home > X

# Title of it
own *text*

* [own link](http://wiki.example.com/x/1)
* [side link]({site}/x/2)
```
无标签 in code
```
|a|bbb|
|---|--:|
|长|d|
<div hidden>
secret
</div>
after

© 2024 Foo Corp

## 评论
X 说：hello
{site}"""
    rules = content.PageRules()
    hidden = content.hidden_lines(page, rules, site)
    assert hidden == [1, 2, 3, 9, 16, 17, 18, 21, 23, 24, 25]
    assert content.render(page, rules, site) == "# Title of it\n\nown *text*\n\n* [own link](http://wiki.example.com/x/1)\n\n```\n无标签 in code\n```\n\na   bbb\n长  d\n\nafter"
    assert content.hidden_lines(None, rules) == [] and content.render(" \n", rules) == ""
    df = pages(spark, [("1", page, "t"), ("1", page, "t"), ("2", None, "t"), ("3", "\r\n", None), ("4", "no title\n" + "x" * 100_000, None), ("5", "# t\n```\nopen", "t")])
    sites = spark.createDataFrame([("t", site)], "tree_id string, base_url string")
    got = content.boilerplate_lines(df, sites)
    assert sorted((r.page_id, r.line_no) for r in got.collect()) == [("1", n) for n in hidden]
    assert content.main_content(df, sites).count() == 3 and content.main_content(df.where("page_id = ''"), sites).count() == 0


# --- near duplicates


def test_bit_sliced_distances_equal_popcounts():
    r = np.random.default_rng(1)
    a, b = (r.integers(0, 256, (1000, 16), dtype=np.uint8) for _ in range(2))
    b[:200] = a[:200] ^ (r.random((200, 16)) < 0.2).astype(np.uint8)
    want = np.unpackbits(a ^ b, axis=1).sum(axis=1)
    for limit in (0, 3, 46, 64, 127, 128):
        assert (nearest.pairs_within(a, b, limit) == (want <= limit)).all()


def brute_pairs(rows, threshold=0.6):
    sets = {}
    for p, m in rows:
        if p is not None and m is not None and m.strip():
            s = set(nearest.shingle_sets([m])[0].tolist())
            if s:
                sets[p] = s
    ids = sorted(sets)
    return {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}


def edited(r, words, share):
    return [r.choice("abcdefgh") * 3 + str(r.randrange(9999)) if r.random() < share else w for w in words]


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    r = random.Random(4)
    rows = []
    for g in range(30):
        base = [f"w{r.randrange(5000)}" for _ in range(150)]
        for k in range(4):
            rows.append((f"{g:02d}-{k}", " ".join(edited(r, base, 0.03 * k))))
    rows += [("copy-a", rows[0][1]), ("copy-a", rows[0][1]), ("copy-b", rows[0][1].upper()), ("null", None), ("blank", " \n"), ("few", "a b c"), (None, rows[0][1]), ("zh", "一二三四五六七八九十"), ("zh2", "一二三四五六七八九十。")]
    df = spark.createDataFrame([(p, m, "x") for p, m in rows], "page_id string, markdown string, page string")
    want = brute_pairs(rows)
    got = [(x.page_a, x.page_b) for x in nearest.near_duplicate_pairs(df, "page_id", "markdown").collect()]
    assert set(got) == want and len(got) == len(want) and len(want) > 50
    monkeypatch.setattr(nearest, "TILE", 2)
    monkeypatch.setattr(nearest, "SAMPLE", 1)
    monkeypatch.setattr(nearest, "PARTNERS", 2)
    again = [(x.page_a, x.page_b) for x in nearest.near_duplicate_pairs(df, "page_id", "markdown").collect()]
    assert set(again) == want and len(again) == len(want)
    groups = {x.page: x for x in nearest.near_duplicate_groups(df, "page_id", "markdown").collect()}
    assert groups["copy-b"].group_id == groups["copy-a"].group_id == groups["00-0"].group_id and all(groups[a].group_id == groups[b].group_id for a, b in want)
    reps = nearest.sketches(df, "page_id", "markdown").groupBy("digest", "short").agg(F.min("page").alias("name"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")).withColumn("rep", F.xxhash64("name"))
    plain = {tuple(x) for x in nearest.candidate_pairs(reps, tile=10_000).collect()}
    tiled = {tuple(x) for x in nearest.candidate_pairs(reps, tile=2).collect()}
    assert plain == tiled and plain
    assert nearest.near_duplicate_pairs(df.where("page_id = 'null'"), "page_id", "markdown").count() == 0


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (3, 9), (7, 8)], "a long, b long")
    assert {tuple(x) for x in nearest.components(links).collect()} == {(1, 1), (2, 1), (3, 1), (9, 1), (4, 4), (5, 4), (7, 7), (8, 7)}


# --- shared spans


def brute_spans(rows, k):
    owners = {}
    for i, t in rows:
        for j in range(len(t or "") - k + 1):
            owners.setdefault(t[j : j + k], set()).add(i)
    out = set()
    for i, t in rows:
        hit = [j for j in range(len(t or "") - k + 1) if len(owners[t[j : j + k]]) > 1]
        start = end = None
        for j in hit:
            if start is None or j > end:
                if start is not None:
                    out.add((i, start, end))
                start = j
            end = j + k
        if start is not None:
            out.add((i, start, end))
    return out


@pytest.mark.parametrize("hot", [20_000, 1])
def test_shared_spans_equal_brute_force(spark, hot):
    r = random.Random(7)
    text = lambda n: "".join(r.choice("abcdeüé😀 一二") for _ in range(n))
    common = [text(60), text(41), text(90)]
    rows = [(i, text(r.randrange(80)) + r.choice(common)[r.randrange(10) :] + text(r.randrange(60)) + r.choice(common)) for i in range(40)]
    rows += [(100, common[2] + common[2]), (101, None), (102, ""), (103, "a" * 500), (104, "b" + "a" * 300), (105, common[0][:39]), (106, rows[0][1]), (106, rows[0][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, doc string")
    got = [(x.doc, x.span_start, x.span_end) for x in spans.shared_spans(df, "doc_id", "text", 40, 12, hot).collect()]
    want = brute_spans(rows, 40)
    assert set(got) == want and len(got) == len(want) and len(want) > 40
    assert spans.shared_spans(df.where("doc_id < 0"), "doc_id", "text", 40, 12).count() == 0


def test_windows_with_equal_hashes_are_compared():
    texts = ["abcdefgh", "abcdefgx"]
    assert spans._by_characters(texts, [1, 2], [1, 2], np.array([0, 0]), 4) == spans.shared_windows(texts, [1, 2], [1, 2], np.array([0, 0]), 4) == [[(0, 4)], [(0, 4)]]


# --- personal information


PARTS = [(p + s, "given", "latin") for p in ("Ald", "Bryn", "Eld", "Fenn", "Juv", "Lorr", "Mirr") for s in ("ane", "aya", "eth", "iel", "ika", "ond")]
PARTS += [(p + s, "family", "latin") for p in ("Brand", "Dorn", "Fael", "Grav", "Kessel", "Lund", "Stov") for s in ("alder", "brick", "dale", "haven", "quist", "wick")]
PARTS += [(a + b, "given", "zh") for a in "砚禾棠屿澈" for b in "舟宁川野遥"] + [(f, "family", "zh") for f in ("澹台", "亓", "邴", "郗")]


def test_held_out_lines():
    from leafmill.llm.personal_training import examples

    redactor = personal.train(PARTS)
    _, lines = examples(PARTS, 1500, seed=99)
    hits = wrong = missed = 0
    for (text, gold), found in zip(lines, redactor.spans([t for t, _ in lines])):
        want, got = {k for _, _, k in gold}, {k for _, _, k in found}
        hits += len(want & got)
        wrong += len(got - want)
        missed += len(want - got)
    assert hits / (hits + wrong) > 0.95 and hits / (hits + missed) > 0.95


def test_placeholders_keep_all_other_text(spark):
    names = spark.createDataFrame(PARTS, "name_part string, part_kind string, script string")
    text = "* Docs contact: Aldane Brandwick, +1-250-555-0124\r\nClone git@git.example.com:a/b.git\n> 电话 １６８-８８４２-３７２９（W）\n联系人：澹台砚舟（+86 161 0488 8998）\n版权所有 © 2872-7905 数据"
    rows = [("1", text), ("1", text), ("2", None), ("3", ""), ("4", " \n"), ("5", "x" * 100_000), (None, "Juvika Faelquist says: hi")]
    df = spark.createDataFrame([(k, t, 1, "z") for k, t in rows], "k string, t string, line_no int, kind string")
    out = {r.k: r.t for r in personal.redacted(df, ["k"], ["t"], names).collect()}
    assert out["1"] == "* Docs contact: [NAME], [PHONE]\r\nClone git@git.example.com:a/b.git\n> 电话 [PHONE]（W）\n联系人：[NAME]" + out["1"].split("[NAME]")[2]
    assert "[PHONE]" in out["1"].split("\n")[3] and out["1"].endswith("\n版权所有 © 2872-7905 数据")
    assert out["2"] is None and out["3"] == "" and out["4"] == " \n" and out["5"] == "x" * 100_000
    found = personal.found_lines(df, "k", "t", names)
    assert sorted((r.rec_key, r.line_no, r.kind) for r in found.collect()) == [("1", 1, "name"), ("1", 1, "phone"), ("1", 3, "phone"), ("1", 4, "name"), ("1", 4, "phone")]
    assert personal.found_lines(df.where("k = ''"), "k", "t", names).count() == 0


def test_queries_have_their_columns(spark):
    from pathlib import Path

    from leafmill.llm.queries import QUERIES

    if not Path("/root/testdata/sf0.001").exists():
        pytest.skip("no test data here")
    want = {"p1_found": ["src", "rec_key", "line_no", "kind"], "p2_found": ["page_id_a", "page_id_b"], "p3_found": ["page_id", "line_no"], "p4_found": ["page_id", "line_no"], "p6_ids": ["doc_id", "ids"], "p7_found": ["source"], "p8_found": ["doc_id", "span_start", "span_end"]}
    for name, columns in want.items():
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert df.columns == columns and df.count() == df.distinct().count()
