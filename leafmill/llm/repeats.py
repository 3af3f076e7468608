"""Lines repeated across one site's pages.

Method: lines are parsed into templates through fixed-depth token trees with wildcard slots. A tree has one level for the site, one for the
number of tokens and ``DEPTH`` for the first tokens; its leaves hold templates. A line joins the leaf's template that shares at least ``SIMILAR`` of its
tokens; the tokens that differ become slots, so slots are learnt from the lines. A template keeps what its slots were filled with (the lines it
took), each fill with up to ``min_pages`` witness pages.

Every partition grows its own tree; trees are merged through their witnesses: a fill, or a template, covers ``min_pages`` pages exactly if its
merged witnesses do, however many rows repeat a page. There are two ways of taking what covers enough pages:

* by fill (the default, and what ``p4_found`` states): lines whose compared form, with digit runs and white space folded, covers ``min_pages`` pages;
* by template (``slots=True``): also lines that differ in the words of a learnt slot, such as the name in "shared by <name>", if all of the template's lines together cover
  ``min_pages`` pages. Templates of several partitions are merged by the same rule within their leaf.

Templates that cover enough pages are found again in the pages. At most ``BROADCAST_TEMPLATES`` of them travel to all tasks, those on most pages first; lines of the
others, which stand on few pages each, are joined by shuffle.

Defined results: null and blank pages have no lines; repeated rows of a page count once; a null site forms a site of
its own. Lines with fewer than ``min_chars`` letters or digits are never removed.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.operators.ranking import distinct_texts
from leafmill.session import cut, spread

MIN_PAGES, MIN_CHARS = 5, 12
#: Levels of the tree that hold tokens, and the share of tokens that a line and its template have in common.
DEPTH, SIMILAR = 2, 0.6
#: At most this many covering templates are sent to the workers whole; lines of the others are joined by shuffle.
BROADCAST_TEMPLATES = 200_000
#: Fills that a task's tree holds, and templates of one leaf, before it emits them and starts afresh; merging is unaffected.
TREE_FILLS, LEAF_TEMPLATES = 200_000, 400
#: Stands for a slot in a template's text.
SLOT = "\x00"

_DIGITS = re.compile("[0-9]+").sub
_OTHER = regex.compile(r"[^\p{L}\p{N}]+").sub


def compared_lines(markdown: str) -> list[str]:
    """The compared form of each line: lower case, digit runs as 0, white space runs as one space, trimmed."""
    return [" ".join(x.split()) for x in _DIGITS("0", markdown.lower()).split("\n")]


def is_long(line: str, min_chars: int = MIN_CHARS) -> bool:
    return len(line) >= min_chars and len(_OTHER("", line)) >= min_chars


def line_digest(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def leaf_of(tokens: list[str]) -> str:
    """The tree's path below the site: token count and first tokens; tokens with a digit are one branch."""
    return "\x01".join([str(len(tokens)), *("0" if "0" in t else t for t in tokens[:DEPTH])])


class Template:
    """Tokens with learnt slots (None), and the witnesses of each fill: [pages seen, pages seen first with their witness, witnesses]."""

    __slots__ = ("tokens", "fills")

    def __init__(self, tokens: list[str | None]):
        self.tokens, self.fills = tokens, {}

    def learn(self, tokens: list[str | None]) -> bool:
        """Takes a line or template in, if it shares enough tokens; those that differ become slots."""
        own = self.tokens
        differing = [i for i, (a, b) in enumerate(zip(own, tokens)) if a != b]
        if len(own) - len(differing) < SIMILAR * len(own):
            return False
        for i in differing:
            own[i] = None
        return True

    def text(self) -> str:
        return " ".join(SLOT if t is None else t for t in self.tokens)


class TemplateTree:
    """A fixed-depth token tree: site -> token count -> first tokens -> leaf of templates."""

    def __init__(self, min_pages: int, learns: bool = True):
        self.min_pages, self.learns, self.leaves, self.known, self.full = min_pages, learns, {}, {}, False

    def add(self, site: str | None, line: str, witness: str) -> None:
        seen = self.known.get((site, line))
        if seen is None:
            seen = self.known[site, line] = self._place(site, line)
            self.full = self.full or len(self.known) >= TREE_FILLS
        seen[0] += 1
        if len(seen[1]) < self.min_pages:
            seen[1].add(witness)
        if witness != seen[3]:
            seen[2] += 1
            seen[3] = witness

    def _place(self, site: str | None, line: str) -> list:
        seen = [0, set(), 0, None]
        if self.learns:
            tokens = line.split(" ")
            leaf = self.leaves.setdefault((site, leaf_of(tokens)), [])
            template = next((t for t in leaf if t.learn(tokens)), None)
            if template is None:
                template = Template(list(tokens))
                leaf.append(template)
                self.full = self.full or len(leaf) >= LEAF_TEMPLATES
            template.fills[line] = seen
        return seen

    def fills(self):
        """(site, fill, pages, changes of witness, witnesses)."""
        for (site, line), (n, witnesses, changes, _) in self.known.items():
            yield site, line, n, changes, witnesses

    def templates(self):
        """(site, leaf, template, pages, witnesses)."""
        for (site, name), leaf in self.leaves.items():
            for template in leaf:
                witnesses: set[str] = set()
                for _, own, _, _ in template.fills.values():
                    if len(witnesses) < self.min_pages:
                        witnesses |= own
                yield site, name, template.text(), sum(f[0] for f in template.fills.values()), set(sorted(witnesses)[: self.min_pages])


def _rows(columns: dict[str, pa.DataType], rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, columns.values())], names=list(columns))


def _chunked(columns: dict[str, pa.DataType], rows, size: int = 50_000):
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _rows(columns, held)
            held = []
    yield _rows(columns, held)


_FILLS = {"site": pa.string(), "digest": pa.binary(), "witness": pa.string(), "n": pa.int64(), "changes": pa.int64()}
_TEMPLATES = {"site": pa.string(), "leaf": pa.string(), "template": pa.string(), "witness": pa.string(), "n": pa.int64()}


def _grown(rows: DataFrame, forms: Callable, min_pages: int, slots: bool = False, learns: bool = True) -> DataFrame:
    """What every partition's tree holds, by witness; page counts stand on one row of each fill or template."""

    def fills(tree):
        for site, line, n, changes, witnesses in tree.fills():
            digest = line_digest(line)
            for i, w in enumerate(witnesses):
                yield site, digest, w, 0 if i else n, 0 if i else changes

    def templates(tree):
        for site, leaf, text, n, witnesses in tree.templates():
            for i, w in enumerate(witnesses):
                yield site, leaf, text, w, 0 if i else n

    columns, emit = (_TEMPLATES, templates) if slots else (_FILLS, fills)

    def grow(batches):
        tree = TemplateTree(min_pages, learns)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                found, witness = forms(*row)
                for line in found:
                    tree.add(row[0], line, witness)
                if tree.full:
                    yield from _chunked(columns, emit(tree))
                    tree = TemplateTree(min_pages, learns)
        yield from _chunked(columns, emit(tree))

    schema = "site string, leaf string, template string, witness string, n long" if slots else "site string, digest binary, witness string, n long, changes long"
    return rows.mapInArrow(grow, schema)


def covering_forms(rows: DataFrame, forms: Callable, min_pages: int, copies: bool = False) -> DataFrame:
    """(site, digest, n, every): fills that stand with at least ``min_pages`` witnesses. With ``copies`` the witnesses are signatures of pages, fills whose pages mostly
    repeat the signature before them (copies of each other) are left out, and a fill that covers two sites has one more row, with ``every``, that counts on all sites."""
    merged = _grown(rows, forms, min_pages, learns=not copies).groupBy("site", "digest", "witness").agg(F.sum("n").alias("n"), F.sum("changes").alias("changes"))
    merged = merged.groupBy("site", "digest").agg(F.count("*").alias("witnesses"), F.sum("n").alias("n"), F.sum("changes").alias("changes")).where(F.col("witnesses") >= min_pages)
    if not copies:
        return merged.select("site", "digest", "n", F.lit(False).alias("every"))
    own = cut(merged.where(2 * F.col("changes") >= F.col("n")).select("site", "digest", "n", F.lit(False).alias("every")))
    both = own.groupBy("digest").agg(F.sum("n").alias("n"), F.count("*").alias("sites")).where("sites > 1")
    return own.unionByName(both.select(F.lit(None).cast("string").alias("site"), "digest", "n", F.lit(True).alias("every")))


class Known:
    """Covering forms as a lookup for tasks: those on most pages by broadcast, the others as a column of each page's own."""

    def __init__(self, shared, cold: DataFrame | None):
        self.shared, self.cold = shared, cold

    def attached(self, rows: DataFrame) -> DataFrame:
        if self.cold is None:
            return rows.withColumn("extra", F.lit(None).cast("array<binary>"))
        same = rows["site"].eqNullSafe(self.cold["site"]) & (rows["page"] == self.cold["page"])
        return rows.join(self.cold, same, "left").select(*[rows[c] for c in rows.columns], "extra")

    def lookup(self, site: str | None, extra: list | None) -> Callable[[str], bool]:
        mine, every = self.shared.value.get((site,), ()), self.shared.value.get((), ())
        own = {bytes(d) for d in extra} if extra else ()

        def recurs(form: str) -> bool:
            digest = line_digest(form)
            return digest in mine or digest in every or digest in own

        return recurs

    def __getstate__(self):
        return {"shared": self.shared, "cold": None}


def _split(covering: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """(rows that are sent to all tasks, the others or None). A row on at least the n-th part of all pages counted is one of at most ``most``."""
    if covering.limit(most + 1).count() <= most:
        return covering, None
    total = covering.agg(F.sum("n")).first()[0]
    bound = total // most + 1 if most else total + 1
    return covering.where(F.col("n") >= bound), covering.where(F.col("n") < bound)


def known_templates(rows: DataFrame, forms: Callable, min_pages: int = MIN_PAGES, copies: bool = False, most: int | None = None) -> Known:
    """The covering forms of ``rows`` (site, page, text, ...), where ``forms`` of a row's values gives its forms and its witness."""
    hot, cold = _split(cut(covering_forms(rows, forms, min_pages, copies)), BROADCAST_TEMPLATES if most is None else most)
    known: dict = {}
    for s, d, every in hot.select("site", "digest", "every").toLocalIterator():  # at most ``most``
        known.setdefault(() if every else (s,), set()).add(bytes(d))
    if cold is not None:

        def own(batches):
            columns = {"site": pa.string(), "page": pa.string(), "digest": pa.binary()}
            for batch in batches:
                every = zip(*(c.to_pylist() for c in batch.columns))
                yield from _chunked(columns, ((r[0], r[1], line_digest(f)) for r in every for f in forms(*r)[0]))

        lines = rows.mapInArrow(own, "site string, page string, digest binary")
        both = lines.alias("l").join(cold.alias("c"), (F.col("c.every") | F.col("l.site").eqNullSafe(F.col("c.site"))) & (F.col("l.digest") == F.col("c.digest")))
        cold = cut(both.groupBy(F.col("l.site").alias("site"), "page").agg(F.collect_set("l.digest").alias("extra")))  # one page's lines
    return Known(rows.sparkSession.sparkContext.broadcast(known), cold)


def _texts(pages: DataFrame, site: str, page: str, text: str) -> DataFrame:
    rows = pages.where(F.col(text).isNotNull() & F.col(page).isNotNull() & F.col(text).rlike(r"\S"))
    return spread(rows.select(F.col(site).alias("site"), F.col(page).alias("page"), F.col(text).alias("text")))


def _long_forms(min_chars: int) -> Callable:
    """(a page's long compared lines, the page)."""
    keep: dict[str, bool] = {}

    def forms(_site, page, text):
        found = set()
        for line in compared_lines(text):
            if len(line) < min_chars or line in found:
                continue
            good = keep.get(line)
            if good is None:
                good = is_long(line, min_chars)
                if len(keep) < 50_000 and len(line) < 80:
                    keep[line] = good
            if good:
                found.add(line)
        return found, page

    return forms


def slot_templates(pages: DataFrame, site: str, page: str, text: str, min_pages: int = MIN_PAGES, min_chars: int = MIN_CHARS) -> DataFrame:
    """(site, leaf, template, n): merged templates that cover at least ``min_pages`` pages; slots are written U+0000, ``n`` is the number of lines counted."""
    grown = _grown(_texts(pages, site, page, text), _long_forms(min_chars), min_pages, slots=True)
    once = grown.groupBy("site", "leaf", "template", "witness").agg(F.sum("n").alias("n"))

    def merge(batches):
        def flush(key, leaf):
            for tokens, n, witnesses in ((t, sum(f[0] for f in t.fills.values()), set().union(*(f[1] for f in t.fills.values()))) for t in leaf):
                if len(witnesses) >= min_pages:
                    yield key[0], key[1], tokens.text(), n

        columns = {"site": pa.string(), "leaf": pa.string(), "template": pa.string(), "n": pa.int64()}
        key, leaf, at, done = None, [], None, []
        for batch in batches:
            for s, name, template, witness, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (s, name) != key:
                    done += flush(key, leaf)
                    key, leaf, at = (s, name), [], None
                if at is None or at[0] != template:
                    tokens = [None if t == SLOT else t for t in template.split(" ")]
                    model = next((t for t in leaf if t.learn(tokens)), None)
                    if model is None:
                        model = Template(tokens)
                        leaf.append(model)
                    at = (template, model.fills.setdefault(template, [0, set()]))
                at[1][0] += n
                if len(at[1][1]) < min_pages:
                    at[1][1].add(witness)
            if len(done) >= 10_000:
                yield _rows(columns, done)
                done = []
        done += flush(key, leaf)
        yield _rows(columns, done)

    by_leaf = once.repartition("site", "leaf").sortWithinPartitions("site", "leaf", "template")
    return by_leaf.mapInArrow(merge, "site string, leaf string, template string, n long")


def repeated_lines(pages: DataFrame, site: str, page: str, text: str, min_pages: int = MIN_PAGES, min_chars: int = MIN_CHARS, slots: bool = False, most: int | None = None) -> DataFrame:
    """(page, line_no): lines whose fill, or with ``slots`` whose template, covers at least ``min_pages`` pages of their site. Each pair once."""
    texts, forms = _texts(pages, site, page, text), _long_forms(min_chars)
    if slots:
        return _in_templates(texts, cut(slot_templates(pages, site, page, text, min_pages, min_chars)), forms, most)
    known = known_templates(texts, forms, min_pages, most=most)
    columns = {"page": pa.string(), "line_no": pa.int32()}

    def mark(batches):
        for batch in batches:
            yield _rows(columns, _marked(zip(*(c.to_pylist() for c in batch.columns)), lambda s, x: known.lookup(s, x), min_chars))

    return known.attached(texts).mapInArrow(mark, "page string, line_no int").distinct()


def _marked(rows, lookup, min_chars: int) -> list[tuple[str, int]]:
    out = []
    for site, page, text, extra in rows:
        recurs = lookup(site, extra)
        out += [(page, n) for n, line in enumerate(compared_lines(text), 1) if len(line) >= min_chars and recurs(line)]
    return out


def _in_templates(texts: DataFrame, covering: DataFrame, forms: Callable, most: int | None) -> DataFrame:
    """The lines that a covering template with slots matches."""
    hot, cold = _split(covering, BROADCAST_TEMPLATES if most is None else most)
    known: dict = {}
    for s, leaf, template in hot.select("site", "leaf", "template").toLocalIterator():  # at most ``most``
        known.setdefault((s, leaf), []).append([None if t == SLOT else t for t in template.split(" ")])
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def mark(batches):
        for batch in batches:
            found = []
            for site, page, text in zip(*(c.to_pylist() for c in batch.columns)):
                long = forms(site, page, text)[0]
                for n, line in enumerate(compared_lines(text), 1):
                    if line in long:
                        tokens = line.split(" ")
                        if any(all(a is None or a == b for a, b in zip(t, tokens)) for t in shared.value.get((site, leaf_of(tokens)), ())):
                            found.append((page, n))
            yield _rows({"page": pa.string(), "line_no": pa.int32()}, found)

    out = texts.mapInArrow(mark, "page string, line_no int")
    if cold is not None:

        def lines(batches):
            for batch in batches:
                found = []
                for site, page, text in zip(*(c.to_pylist() for c in batch.columns)):
                    long = forms(site, page, text)[0]
                    found += [(site, leaf_of(line.split(" ")), page, n, line.split(" ")) for n, line in enumerate(compared_lines(text), 1) if line in long]
                yield _rows({"site": pa.string(), "leaf": pa.string(), "page": pa.string(), "line_no": pa.int32(), "tokens": pa.list_(pa.string())}, found)

        every = texts.mapInArrow(lines, "site string, leaf string, page string, line_no int, tokens array<string>").alias("l")
        models = cold.select("site", "leaf", F.split("template", " ").alias("model")).alias("c")
        fits = F.forall(F.zip_with("l.tokens", "c.model", lambda a, b: (b == SLOT) | (a == b)), lambda x: x)
        both = every.join(models, F.col("l.site").eqNullSafe(F.col("c.site")) & (F.col("l.leaf") == F.col("c.leaf")) & fits)
        out = out.unionByName(both.select(F.col("l.page").alias("page"), F.col("l.line_no").alias("line_no")))
    return out.distinct()


def without_repeated_lines(pages: DataFrame, site: str, page: str, text: str, min_pages: int = MIN_PAGES, min_chars: int = MIN_CHARS, slots: bool = False) -> DataFrame:
    """(site, page, text): each page once, without its repeated lines; null and blank texts come out as they are.

    Lines are taken out where the page is read; only keys and digests of texts travel (to drop repeated rows), and with ``slots`` the lines' numbers.
    """
    once = distinct_texts(pages.select(site, page, text), [site, page], text)
    if slots:
        found = repeated_lines(pages, site, page, text, min_pages, min_chars, True).groupBy("page").agg(F.collect_set("line_no").alias("__drop"))
        kept = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains("__drop", (i + 1).cast("int")))
        out = once.join(found.withColumnRenamed("page", "__page"), F.col(page) == F.col("__page"), "left")
        return out.select(site, page, F.when(F.col("__drop").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")).alias(text))
    known = known_templates(_texts(pages, site, page, text), _long_forms(min_chars), min_pages)
    rows = known.attached(spread(once.select(F.col(site).cast("string").alias("site"), F.col(page).cast("string").alias("page"), F.col(text).alias("text"))))

    def remove(batches):
        for batch in batches:
            texts = []
            for s, body, extra in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if body is not None and body.strip():
                    recurs = known.lookup(s, extra)
                    body = "\n".join(raw for raw, line in zip(body.split("\n"), compared_lines(body)) if len(line) < min_chars or not recurs(line))
                texts.append(body)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["site", "page", "text"])

    return rows.mapInArrow(remove, "site string, page string, text string").select(F.col("site").alias(site), F.col("page").alias(page), F.col("text").alias(text))
