"""String expressions for titles, paths, URLs and Markdown lines. All take and return columns and stay in the JVM.

White space is Unicode white space plus U+001C-U+001F. A null input gives the default a function names, or null where it names none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\s\x1c-\x1f]"
#: Line ends: CRLF, LF, CR, VT, FF, U+001C-U+001E, NEL, LS, PS.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
#: Characters that aren't allowed in a file name (fixed values).
FORBIDDEN = r'[\\/:*?"<>|]'


def strip(x: Column) -> Column:
    return F.regexp_replace(x, rf"(?U)\A{WS}++|(?<!{WS}){WS}++\z", "")


def rstrip(x: Column) -> Column:
    """The lookbehind lets only the start of a run of white space be tried, so long runs stay linear."""
    return F.regexp_replace(x, rf"(?U)(?<!{WS}){WS}++\z", "")


def lstrip_newlines(x: Column) -> Column:
    return F.regexp_replace(x, r"\A\n+", "")


def filled(x: Column) -> Column:
    """The column, or null where it is empty."""
    return F.nullif(x, F.lit(""))


def split_lines(x: Column) -> Column:
    """Lines without their ends; a final line end opens no further line; the empty text has none."""
    parts = F.split(x, LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def lines_with_ends(x: Column) -> Column:
    other = r"[^\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
    return F.regexp_extract_all(x, F.lit(rf"{other}*+(?:{LINE_END})|{other}++\z"), F.lit(0))


def file_name(title: Column) -> Column:
    """A title as a file or folder name: forbidden characters become ``_``; null and blank give ``untitled``."""
    return F.coalesce(filled(strip(F.regexp_replace(F.coalesce(title, F.lit("")), FORBIDDEN, "_"))), F.lit("untitled"))


def folder_segment(slug: Column, title: Column, page_id: Column) -> Column:
    """The folder of a page: its slug if not blank, else its title if not empty, else ``page_<id>``."""
    return F.coalesce(
        F.when(strip(F.coalesce(slug, F.lit(""))) != "", file_name(strip(slug))),
        file_name(F.coalesce(filled(title), F.concat(F.lit("page_"), F.coalesce(page_id, F.lit(""))))),
    )


def plain_title(title: Column, site_name: str) -> Column:
    """A browser title without its ``- space - <site_name>`` ending; otherwise stripped. Null gives the empty text."""
    t = strip(F.coalesce(title, F.lit("")))
    quoted = r"\s+".join(rf"\Q{word}\E" for word in site_name.split())
    found = F.regexp_extract(t, rf"(?iUd)\A(.+?)\s+-\s+.+\s+-\s*{quoted}\s*\z", 1)
    return F.coalesce(filled(strip(found)), t)


def page_stem(node_title: Column, fetched_title: Column, slug: Column, page_id: Column, site_name: str) -> Column:
    """The file stem of a page: node title, else cleaned fetched title, else folder segment."""
    title = strip(F.coalesce(node_title, F.lit("")))
    fetched = plain_title(fetched_title, site_name)
    return F.when(title != "", file_name(title)).when(fetched != "", file_name(fetched)).otherwise(folder_segment(slug, node_title, page_id))


def page_path(folder: Column, stem: Column) -> Column:
    return F.concat_ws("/", filled(folder), F.concat(stem, F.lit(".md")))


def attachment_name(name: Column, most: int = 180) -> Column:
    """A safe attachment name, cut to ``most`` characters; null and blank give ``attachment``."""
    safe = strip(F.translate(F.coalesce(name, F.lit("")), '<>:"/\\|?*', "_________"))
    return F.substring(F.coalesce(filled(safe), F.lit("attachment")), 1, most)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def percent_decoded(x: Column) -> Column:
    """Percent escapes decoded as UTF-8, with U+FFFD for bytes that aren't; ``+`` and ``%`` without two hexadecimal digits stay."""
    pieces = F.regexp_extract_all(x, F.lit(r"(?:%[0-9A-Fa-f]{2})++|[^%]++|%"), F.lit(0))
    escaped = lambda p: F.decode(F.unhex(F.replace(p, F.lit("%"), F.lit(""))), "UTF-8")
    decoded = F.transform(pieces, lambda p: F.when(F.startswith(p, F.lit("%")) & (F.length(p) > 1), escaped(p)).otherwise(p))
    return F.when(F.contains(x, F.lit("%")), F.array_join(decoded, "")).otherwise(x)


def url_file_name(url: Column) -> Column:
    """The decoded last path segment as a safe name; ``attachment.bin`` where there is none."""
    last = F.substring_index(url_path(url), "/", -1)
    return F.when(last != "", attachment_name(F.substring_index(percent_decoded(last), "?", 1))).otherwise("attachment.bin")


def collision_name(url: Column, name: Column) -> Column:
    return F.concat(F.substring(F.md5(url.cast("binary")), 1, 8), F.lit("_"), name)


def download_url(base: Column, link: Column) -> Column:
    """An absolute download URL: absolute links stay, empty ones stay empty, others are put behind the base."""
    t, b = strip(F.coalesce(link, F.lit(""))), F.rtrim(base, F.lit("/"))
    return F.when(F.lower(t).rlike(r"^https?://"), t).when(t == "", "").when(t.startswith("/"), F.concat(b, t)).otherwise(F.concat(b, F.lit("/"), t))


def site_bases(text: Column, default: str = "") -> Column:
    """Distinct site addresses in a text in the order found: before ``/pages/``, then before ``/download/attachments/``; else the host of a page link,
    else any host, else the default."""
    stop = r"[^\s\"'`()<>\]]+"
    found = F.concat(
        F.regexp_extract_all(text, F.lit(rf"(?iU)(https?://{stop})(?=/pages/)"), F.lit(1)), F.regexp_extract_all(text, F.lit(rf"(?iU)(https?://{stop})(?=/download/attachments/)"), F.lit(1))
    )
    found = F.array_distinct(F.transform(found, lambda b: F.rtrim(b, F.lit("/"))))
    one = F.coalesce(filled(F.regexp_extract(text, r"(?i)(https?://[a-z0-9.:\-]+)(?=/pages/[^ \n)\"']*[?&]pageId=)", 1)), filled(F.regexp_extract(text, r"(?i)(https?://[a-z0-9.:\-]+)(?=/)", 1)), filled(F.lit(default)))
    return F.when(F.size(found) > 0, found).when(one.isNotNull(), F.array(F.rtrim(one, F.lit("/")))).otherwise(F.array().cast("array<string>"))


def page_ids(text: Column) -> Column:
    """Distinct page ids of the links in a text, in numeric order."""
    ids = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?i)[?&]pageId=(\d+)"), F.lit(1)))
    padded = F.array_sort(F.transform(ids, lambda i: F.struct(F.length(F.regexp_replace(i, "^0+", "")).alias("n"), F.regexp_replace(i, "^0+", "").alias("v"), i.alias("id"))))
    return F.transform(padded, lambda s: s["id"])


def attachment_urls(text: Column) -> Column:
    """Distinct direct attachment links of a text, sorted as text."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?iU)(https?://[^)\s\"']+/download/attachments/[^)\s\"']+)"), F.lit(1))))


def compared_title(x: Column) -> Column:
    """A title line for comparison: stripped, without heading marks, white space folded, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(strip(x), r"(?U)\A#{1,6}\s+", ""), rf"(?U){WS}+", " "))


def yaml_scalar(x: Column) -> Column:
    """A YAML scalar: ``""`` for null and empty, quoted where needed, else bare. Line breaks stay as they are."""
    v = F.coalesce(x, F.lit(""))
    needs = v.rlike(r"[\n:#{}\[\]&*!|>'\",]") | (strip(v) != v)
    return F.when(v == "", '""').when(needs, yaml_quoted(v)).otherwise(v)


def yaml_quoted(x: Column) -> Column:
    v = F.replace(F.replace(F.coalesce(x, F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), v, F.lit('"'))


def squeezed_keeping_crlf(x: Column) -> Column:
    """Three and more line breaks (LF or CRLF) become two LF; all else stays."""
    return F.regexp_replace(x, r"(?:\r?\n){3,}+", "\n\n")


def squeezed(x: Column) -> Column:
    """CRLF and CR become LF, then three and more become two."""
    return F.regexp_replace(F.replace(F.replace(x, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), r"\n{3,}", "\n\n")


def normal_path(x: Column, windows: bool = False) -> Column:
    """A path for comparison; with ``windows`` in lower case with backslashes."""
    return F.lower(F.replace(x, F.lit("/"), F.lit("\\"))) if windows else x


def next_start(link: Column, start: Column, limit: Column) -> Column:
    """The ``start`` of a next-page link; ``start + limit`` where it is missing or no number; null without a link (no further page)."""
    named = F.regexp_extract(link, r"[?&]start=([^&#]*)", 1).try_cast("int")
    return F.when(link.isNull() | (link == ""), F.lit(None).cast("int")).otherwise(F.coalesce(named, start + limit))


def attachment_count(before: Column) -> Column:
    """The last attachment count in the text before a link, or null."""
    forms = r"(?i)附件[（(]\d+[）)]|\[t[（(]\d+[）)]\]|t[（(]\d+[）)](?U:\s)*附件|t附件[（(]\d+[）)]"
    every = F.regexp_extract_all(before, F.lit(forms), F.lit(0))
    return F.when(F.size(every) > 0, F.regexp_extract(F.element_at(every, -1), r"(\d+)", 1))


def markdown_path(path: Column) -> Column:
    """A path with its extension replaced by ``.md``; a leading-dot name has none."""
    return F.concat(F.regexp_replace(path, r"(?<=[^/])\.[^./]+\z", ""), F.lit(".md"))


def extension(path: Column) -> Column:
    """The lower-case extension with its dot, or the empty text."""
    return F.lower(F.regexp_extract(path, r"[^/](\.[^./]+)\z", 1))


def viewing_url(base: Column, page_id: Column) -> Column:
    return F.concat(F.rtrim(base, F.lit("/")), F.lit("/pages/viewpage.action?pageId="), page_id)


def setting(*choices: Column, default: str = "", trim: bool = True) -> Column:
    """The first choice that isn't blank, else the default; ``trim`` strips it (a password is taken as it is)."""
    kept = [filled(strip(c)) if trim else filled(c) for c in choices]
    return F.coalesce(*kept, F.lit(default))
