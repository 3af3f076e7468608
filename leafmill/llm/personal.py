"""Personal information inside free text.

Method: candidate gradient boosting. High-recall generators propose overlapping spans of mail addresses, phone numbers, identity numbers,
street addresses and names; boosted trees score each span from features of its format and its context; thresholds
calibrated on held-out examples select the spans, and the most probable of overlapping ones wins. The trees are trained here, on
``TRAIN_LINES`` labelled lines that :mod:`leafmill.llm.personal_training` makes (a documented, fixed bound). Names are proposed by parts of a list that is known to be incomplete (a part may also be
recognised by stem and ending that recur in the list), by common given names, and by form and context alone: capitalised words behind a form of address, a label or a sign-off, Chinese
surnames before a form of address or behind a label. A list of more than ``MOST_NAME_PARTS`` parts, which travels to all tasks, is an error.

Defined results: null, empty and blank texts have no spans and come out unchanged; all text outside of spans is unchanged; repeated rows give
the same result each; a name that is only part of a mail address is part of that address.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.boosting import Boosted
from leafmill.session import spread

KINDS = ("email", "phone", "id_number", "address", "name")
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}
#: Labelled lines that the trees are trained on.
TRAIN_LINES = 8000
MOST_NAME_PARTS = 1_000_000
#: Characters of context, within the line, that features look at.
LEFT, RIGHT = 26, 22

#: Full-width forms and odd spaces, one for one, so that positions stay.
_FOLD = {0xFF10 + i: chr(0x30 + i) for i in range(10)} | {0xFF0B: "+", 0xFF08: "(", 0xFF09: ")", 0xFF0D: "-", 0xFF20: "@", 0xFF0E: ".", 0xFF0F: "/", 0xA0: " ", 0x3000: " ", 0x2009: " ", 0x202F: " ", 0x2003: " ", 0x2002: " ", 0x9: " "}
_FOLDED = re.compile("[" + "".join(map(chr, _FOLD)) + "]")

_AT = re.compile(r"@|[\[(]\s?(?:at|a|æt)\s?[\])]|(?<=\w) at (?=[\w-]+ dot )", re.I)
_LOCAL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63} ?\Z")
_DOMAIN = re.compile(r" ?[A-Za-z0-9\-]+(?: ?(?:\.|[\[(]dot[\])]| dot ) ?[A-Za-z0-9\-]+)+", re.I)
_NUMBER = re.compile(r"(?:(?<![A-Za-z0-9.=_\-+(])|(?<=[A-Za-z])(?=\([+(]{0,2}\d))[+(]{0,3}\d[\d ()\-./]{3,}[\dXx](?![A-Za-z0-9_])")
_LETTERED = re.compile(r"(?<![A-Za-z0-9])(?:[A-Z]{1,2} ?\d{2,3} ?\d{3,4} ?\d{0,3}|[A-Z](?=[A-Z0-9]*\d[A-Z0-9]*\d[A-Z0-9]*\d)[A-Z0-9]{8})(?![A-Za-z0-9])")
_ZH_NUMBER = re.compile(r"(?<=[一-鿿])\s?\d{1,5}\s?(?:号|弄)")
_ZH_ROAD = re.compile(r"(?:[一-鿿]{1,5}(?:省|市|区|县|镇))*[一-鿿]{1,12}?(?:大道|路|街|巷|胡同|里|道|弄)$")
_HAN = re.compile("[一-鿿]")
#: Words that may stand before an address and don't belong to it.
_ZH_LEAD = ("寄往", "寄到", "寄至", "送往", "位于", "住在", "地址")
_ZH_REST = re.compile(r"(?:\s?\d+(?:号楼|号|栋|幢|单元|楼|室))*")
_EN_ROAD = re.compile(r"(?<=[a-z] )(?:road|rd|street|st|avenue|ave|lane|ln|drive|dr|close|court|ct|way|place|terrace|boulevard|blvd|crescent|square)\b\.?", re.I)
_EN_HOUSE = re.compile(r"(?:(?:flat|apt|unit)\.? ?\w{1,5},? )?(?<![\w-])\d{1,5}[a-z]? +(?:[A-Za-z][\w'-]+ +){1,5}$", re.I)
_EN_REST = re.compile(r"(?:,? +(?:[Aa]pt|[Uu]nit|[Ss]uite|APT)\.? ?\w{1,5})?(?:,? +[A-Z][a-z]+)?(?: \d{5}\b)?")
_DE_ROAD = re.compile(r"(?:(?<![\wäöüß])[A-ZÄÖÜ][\wäöüß-]*?(?:straße|strasse|str\.|weg|gasse|allee|platz|ring|damm|ufer)|(?<![\wäöüß])(?:Am|An der|Im|Auf dem|Zum|Zur|In der) [A-ZÄÖÜ][a-zäöüß]+) +\d{1,4} ?[a-z]?\b(?:, \d{5} [A-ZÄÖÜ][\wäöüß]+(?: [A-ZÄÖÜ][\wäöüß]+)?)?")
_DE_HINTS = ("straße ", "strasse ", "str. ", "weg ", "gasse ", "allee ", "platz ", "ring ", "damm ", "ufer ", "Am ", "An der ", "Im ", "Auf dem ", "Zum ", "Zur ", "In der ")
_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]{4,}")
_CAMEL = re.compile(r"[A-Z][a-zäöüß]{2,}(?=[A-Z][a-zäöüß]{2,}\b)")
_TITLED = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herrn?|Frau|Sir|Dame|Señor|Madame|Monsieur)\b\.? +((?:(?:Dr|Prof)\. +)?(?:[A-ZÀ-ÖØ-Þ][\w'’-]+|[A-Z]\.)(?: +(?:von|van|de|der|di)(?= ))?(?: +(?:[A-ZÀ-ÖØ-Þ][\w'’-]+|[A-Z]\.)){0,2})")
_LABELLED = re.compile(r"\b(?:name|contact|author|(?:written|signed|posted|edited|reviewed) by|from|attendee|applicant|patient|signed|regards|best|cheers|thanks|grüße|gruß|ansprechpartner(?:in)?|autor(?:in)?|verfasser(?:in)?)\b *[:,]? *\n? *((?-i:[A-ZÀ-ÖØ-Þ][\w'’-]+(?: +[A-Z]\.)? +[A-ZÀ-ÖØ-Þ][\w'’-]+))(?![\w'’-])", re.I)
_GIVEN_FIRST = re.compile(r"(?<![\w'’-])([A-ZÀ-ÖØ-Þ][\w’]+(?:-[A-ZÀ-ÖØ-Þ]\w+)?)((?: [A-Z]\.)? (?:(?:von|van|de|der|di|la) )*)([A-ZÀ-ÖØ-Þ][\w'’]+(?:-[A-ZÀ-ÖØ-Þ]\w+)?)(?![\w’-])")
_ZH_TITLED = re.compile("(?=([{s}][一-鿿]{1,2}?)(?:先生|女士|老师|同学|医生|教授|经理|主任))")
_ZH_LABELLED = re.compile("(?:姓名|联系人|作者|申请人|患者|负责人|签名)\\s*[:：]\\s*([{s}][一-鿿]{1,2})(?![一-鿿])")
_AFTER = re.compile("(, *| +|[._-])(?:([A-Za-zÀ-ÖØ-öø-ÿ]{3,})|([A-Za-zÀ-ÖØ-öø-ÿ])\\.)")
_CUES = {
    "phone_left": r"电话|手机|值班|值守|联系|\btel|phone|\bmobil|fon\b|bereitschaft|notruf|\bcall\b|number|\breach|\bring\b|ansprech|contact|\b[mt] \(.*\):?\s*$|\bfax|\bat\s*$|\bunter\s*$",
    "phone_right": r"ext|\bor [\w.+-]+|或|邮箱|,? [\w.+-]+@",
    "id_left": r"身份证|证件|护照|社保|passport|ssn|social|ausweis|identity|id card|reisepass",
    "not_left": r"流水|单号|批次|serial|vorgang|teil|part|版本|version|release|build|©|版权|copyright|端口|\bport|host|page|code|ticket|order|编号|rechnung|invoice|created|updated|modified|geändert|datum|date|日期|时间|\b(?:on|am|vom|于)\s*$|v\s?$",
    "not_right": r"^\s*(?:bot|机器人|版|批|belongs|passt|gehört|durch|by\b|自动|automat)",
    "address_left": r"办公室|地址|寄往|寄送|ship|sent to|anschrift|gingen an|office|flat|apt|:\s*$|,\s*$",
    "address_not": r"项目|代号|计划|工程|改造|track|project|programme|initiative|team|projekt|vorhaben|heißt",
    "name_left": r"联系人|收件人|记录人|联系|登记|姓名|作者|由\s*\[?$|\bby\s*\[?$|\bvon\s*\[?$|\bto\s*$|\ban\s*$|reach\s*$|ask\s*$|contact|ansprech|protokoll|minutes|notes|author|verfasser|autor|antrag|form\b|@\s?$|^\s*[>*|+-]?\s*$|\|\s*$|passport|attended|patient|applicant",
    "name_right": r"^\s*(?:说|回复|(?:（|\()|·|在|replied|says|said|wrote|asked|schreibt|meint|sagt|vor \d|, \d+ days|, vor|,|，|。|\.|angelegt|updated|\||please|bitte|请|\]|/|<|\[|$)",
    "product_right": r"^\s*(?:连接器|connector|adapter|plugin|street|straße|road|avenue|项目|版|组|侧|group|works|systems|labs|docs|gmbh|inc|小组|环境|导出)",
}
_CUE = {k: re.compile(v, re.I) for k, v in _CUES.items()}
#: Common given names of several languages (fixed values, common knowledge).
COMMON_GIVEN = set("""adam adrian alan albert alex alexander alice amanda amy ana andrea andreas andrew angela anita anna anne anton antonio arthur barbara ben benjamin bernd birgit brian carl carla carlos carmen carol
caroline catherine charles charlotte chloe chris christian christina christine christoph claire clara claudia daniel david deborah dennis diana diego dieter dominik dorothy edward elena elisabeth elizabeth ella emily emma eric
erik eva fatima felix fernando florian frank franz fritz gabriel george gerhard grace günter hannah hans harald harry heike heinz helen helena henry ingrid isabel jack jacob james jan jane jason jean jeff jennifer jens jessica joan johann john
jonas jonathan jorge josef joseph juan julia julie jürgen karen karin karl kate katharina katrin kevin klaus laura leon linda lisa lucas lucia luis lukas marco margaret maria marie mark markus martin mary matthew matthias max michael miguel
mohammed monika nicole nina olga oliver patricia patrick paul paula peter petra philipp rachel ralf rebecca richard robert rosa sabine samuel sandra sara sarah sebastian simon sofia sophie stefan stephanie stephen steven susan susanne thomas timothy tobias ursula uwe victoria
werner william wolfgang""".split())
#: Two-character surnames, and single ones that are rare as words (fixed values, common knowledge).
COMPOUND_SURNAMES = set("欧阳 太史 端木 上官 司马 东方 独孤 南宫 万俟 闻人 夏侯 诸葛 尉迟 公羊 赫连 澹台 皇甫 宗政 濮阳 公冶 太叔 申屠 公孙 慕容 仲孙 钟离 长孙 宇文 司徒 鲜于 司空 闾丘 子车 亓官 司寇 巫马 公西 颛孙 壤驷 公良 漆雕 乐正 宰父 谷梁 拓跋 夹谷 轩辕 令狐 段干 百里 呼延 东郭 南门 羊舌 微生 梁丘 左丘 东门 西门".split())
#: Single surnames that are words too: they count next to a form of address or a label only.
WORD_SURNAMES = set("张何马高林罗刘黄金于万方石江白田叶任文史龙安常易武乔温谷左")
SINGLE_SURNAMES = set("赵钱孙李周吴郑王冯陈褚卫蒋沈韩杨朱秦尤许吕施孔曹严魏陶姜戚谢邹喻柏窦章苏潘葛奚范彭郎鲁韦昌苗俞袁柳酆鲍廉岑薛雷贺倪汤滕殷罗毕郝邬傅卞康伍余卜顾孟黄穆萧尹姚邵湛汪祁毛禹狄臧戴宋庞熊纪舒屈项祝董杜阮闵贾娄郭梅林刁徐邱骆蔡田樊胡凌霍虞柯卢莫邓亓邴郗缑岐仉逄庹厍逯宓")


class Names:
    """The name list, with the stems and endings that recur in it."""

    def __init__(self, parts: list[tuple[str, str, str]]):
        take = lambda kind, script: {p.strip().lower() for p, k, s in parts if p and k == kind and s == script}
        self.given, self.family = take("given", "latin"), take("family", "latin")
        self.zh_given, self.zh_family = take("given", "zh"), take("family", "zh")
        self.forms = {"given": self._forms(self.given), "family": self._forms(self.family)}
        self.first = {g[0] for g in self.zh_given if len(g) == 2}
        self.second = {g[1] for g in self.zh_given if len(g) == 2}
        self.zh = re.compile(f"[{''.join(sorted(self.first))}]\\s?[{''.join(sorted(self.second))}]") if self.first else None
        self.known: dict[str, tuple[float, float]] = {}
        surnames = "".join(sorted(SINGLE_SURNAMES | WORD_SURNAMES | {f for f in self.zh_family if len(f) == 1}))
        self.zh_titled, self.zh_labelled = (re.compile(p.pattern.replace("{s}", surnames)) for p in (_ZH_TITLED, _ZH_LABELLED))

    @staticmethod
    def _forms(words: set[str]) -> tuple[set[str], set[str]]:
        stems, ends = Counter(), Counter()
        for w in words:
            for i in range(3, len(w) - 1):
                stems[w[:i]] += 1
                ends[w[i:]] += 1
        return {s for s, n in stems.items() if n >= 3}, {e for e, n in ends.items() if n >= 5 and len(e) >= 2}

    def score(self, word: str) -> tuple[float, float]:
        """(as a given name, as a family name): 2 if listed, 1 if made of a recurring stem and ending, else 0."""
        found = self.known.get(word)
        if found is None:
            w = word.lower().replace("oe", "ö") if "stroem" in word.lower() else word.lower()
            out = []
            for kind, listed in (("given", self.given), ("family", self.family)):
                stems, ends = self.forms[kind]
                made = any(w[:i] in stems and w[i:] in ends for i in range(3, len(w) - 1))
                out.append(2.0 if w in listed else 1.0 if made else 0.0)
            found = (out[0], out[1])
            if len(self.known) > 300_000:
                self.known.clear()
            self.known[word] = found
        return found


def fold(text: str) -> str:
    return _FOLDED.sub(lambda m: _FOLD[ord(m[0])], text)


def _near(text: str, start: int, end: int) -> tuple[str, str]:
    """The context within the line."""
    left = text[max(0, start - LEFT) : start].rpartition("\n")[2]
    return left, text[end : end + RIGHT].partition("\n")[0]


def _cn_id(digits: str) -> bool:
    return len(digits) == 18 and "1900" <= digits[6:10] <= "2030" and "01" <= digits[10:12] <= "12" and "01" <= digits[12:14] <= "31"


def _has(cue: str, text: str) -> float:
    return 1.0 if _CUE[cue].search(text) else 0.0


def _emails(text: str):
    for m in _AT.finditer(text):
        local = _LOCAL.search(text[max(0, m.start() - 66) : m.start()])
        domain = _DOMAIN.match(text, m.end())
        if not local or not domain:
            continue
        start, end = m.start() - (len(text[max(0, m.start() - 66) : m.start()]) - local.start()), domain.end()
        name, host = text[start : m.start()].strip().lower(), domain[0].strip().lower()
        tld = re.split(r"\.| dot |[\[(]dot[\])]", host)[-1].strip()
        yield start, end, [
            m[0] == "@", tld.isalpha(), len(tld), tld in ("png", "jpg", "jpeg", "gif", "svg", "webp", "js", "css", "md", "zip"), bool(re.match(r"\d", host)), bool(re.search(r"\d+\.\d+", host)),
            name in ("git", "svn", "hg", "root"), text[end : end + 1] == ":", text[end : end + 1] == "/", text[max(0, start - 1) : start] in ("/", ":"), len(name), len(host), host.count("."),
        ]


def _numbers(text: str):
    for pattern in (_NUMBER, _LETTERED):
        for m in pattern.finditer(text):
            s, start, end = m[0], m.start(), m.end()
            digits = re.sub(r"[^0-9xX]", "", s)
            n = len(digits)
            left, right = _near(text, start, end)
            groups = re.findall(r"\d+", s)
            bare = digits[2:] if digits.startswith("86") and n == 13 else digits[4:] if digits.startswith("0086") else digits
            token = text[max(0, text.rfind(" ", max(0, start - 120), start)) : start]
            yield start, end, [
                n, len(groups), max(map(len, groups)), min(map(len, groups)), "+" in s[:3], digits.startswith("00"), digits.startswith("0"), "(" in s, s.count("-"), s.count("."), s.count("/"), s.count(" "),
                s[0].isalpha(), digits[-1:] in "xX", len(bare) == 11 and bare[0] == "1" and bare[1] in "3456789", n in (7, 10, 11) and "555" in groups, left.rstrip()[-1:] in tuple(",(:/"), "：" in left[-2:], _cn_id(digits), [len(g) for g in groups] in ([3, 2, 4], [9]),
                bool(re.fullmatch(r"\d{4}[-./]\d{1,2}[-./]\d{1,2}|\d{1,2}[-./]\d{1,2}[-./]\d{4}|(?:19|20)\d\d-(?:19|20)\d\d", s)), bool(re.fullmatch(r"\d{1,3}(?:\.\d{1,3}){3}", s)),
                _has("phone_left", left), _has("phone_right", right), _has("id_left", left), _has("not_left", left), _has("not_right", right), left[-1:] == "[", left[-1:] in ("/", "<"), "http" in token or "=" in token[-12:],
                [len(g) for g in groups] in ([3, 4], [3, 3, 4]) , digits.startswith(("020", "030", "0171", "44", "49", "004", "1")),
            ]


def _addresses(text: str):
    for m in _ZH_NUMBER.finditer(text):
        first = m.start()
        while first and _HAN.match(text, first - 1):
            first -= 1
        ahead = text[first : m.start()]
        road = _ZH_ROAD.search(ahead)
        if road:
            lead = max((road[0].rfind(v) + len(v) for v in _ZH_LEAD if v in road[0]), default=0)
            start = m.start() - (len(ahead) - road.start()) + (lead if lead < len(road[0]) - 1 else 0)
            end = _ZH_REST.match(text, m.end()).end()
            yield start, end, _address_features(text, start, end, 1, road[0].endswith(("路", "街", "巷", "大道", "胡同")), m[0].strip())
    for m in _EN_ROAD.finditer(text):
        ahead = text[_words_back(text, m.start(), 10) : m.start()]
        house = _EN_HOUSE.search(ahead)
        if house:
            start = m.start() - (len(ahead) - house.start())
            end = _EN_REST.match(text, m.end()).end()
            yield start, end, _address_features(text, start, end, 2, not m[0].islower(), house[0])
    for m in _DE_ROAD.finditer(text) if any(h in text for h in _DE_HINTS) else ():
        yield m.start(), m.end(), _address_features(text, m.start(), m.end(), 3, not m[0].startswith(("Am ", "An ", "Im ", "Auf ", "Zum ", "Zur ", "In ")), m[0])


def _words_back(text: str, at: int, words: int) -> int:
    """Where the line's last ``words`` words before ``at`` begin."""
    line = text.rfind("\n", 0, at) + 1
    for _ in range(words):
        at = text.rfind(" ", line, max(line, at - 1))
        if at < 0:
            return line
    return at + 1


def _address_features(text: str, start: int, end: int, language: int, strong: bool, house: str) -> list:
    left, right = _near(text, start, end)
    number = re.search(r"\d+", house)
    return [language, strong, len(number[0]) if number else 0, end - start, _has("address_left", left), _has("address_not", left + right), bool(re.search(r"\d{5}", text[start:end])), left.strip() == "", right.strip() == "", "," in text[start:end], _has("name_left", left)]


def _letter(c: str) -> bool:
    return c.isalpha() and c < "\u2e80"


def _names(text: str, names: Names):
    for word in set(_WORD.findall(text)):
        family = names.score(word)[1]
        camel = _CAMEL.match(word) if not family else None
        if camel and names.score(word[camel.end() :])[1] and names.score(camel[0])[0]:
            at = text.find(word)
            while at >= 0:
                end = at + len(word)
                if not (_letter(text[end : end + 1]) or _letter(text[max(0, at - 1) : at])):
                    yield at, end, _name_features(text, at, end, names.score(camel[0])[0], names.score(word[camel.end() :])[1], 3, False, 0)
                at = text.find(word, end)
        if not family:
            continue
        at = text.find(word)
        while at >= 0:
            end = at + len(word)
            if not (_letter(text[end : end + 1]) or _letter(text[max(0, at - 1) : at])):
                start, first, gap = _word_before(text, at)
                after = _AFTER.match(text, end)
                if first:
                    initial = len(first.rstrip(".")) == 1
                    given = 0.0 if initial else names.score(first)[0]
                    yield start, end, _name_features(text, start, end, given, family, 0 if gap.strip() == "" else 1, initial, (1 if word.islower() else 2 if word.isupper() else 0))
                if after and ("," in after[1] or after[3] or names.score(after[2])[0]):
                    yield at, after.end(), _name_features(text, at, after.end(), names.score(after[2])[0] if after[2] else 0.0, family, 2 if "," in after[1] else 10, not after[2], (1 if word.islower() else 2 if word.isupper() else 0))
            at = text.find(word, end)
    yield from _formed_names(text, names)
    for m in names.zh.finditer(text) if names.zh else ():
        tail = text[max(0, m.start() - 4) : m.start()].rpartition("\n")[2]
        packed = tail.replace(" ", "")
        surname, listed = "", 0.0
        for size in (2, 1):
            s = packed[-size:]
            if len(s) == size and (s in names.zh_family or (size == 2 and s in COMPOUND_SURNAMES) or (size == 1 and s in SINGLE_SURNAMES)):
                surname, listed = s, 2.0 if s in names.zh_family else 1.0
                break
        if not surname:
            continue
        used, k = 0, len(tail)
        while used < len(surname):
            k -= 1
            used += tail[k] != " "
        start = m.start() - (len(tail) - k)
        given = m[0].replace(" ", "")
        yield start, m.end(), _name_features(text, start, m.end(), 2.0 if given in names.zh_given else 1.0, listed + 3 * len(surname), 4, False, 0)


def _word_before(text: str, at: int) -> tuple[int, str, str]:
    """(start, word, gap) of the word, or initial with or without a dot, before ``at`` in the line; empty without one."""
    k = at
    while k and text[k - 1] in " ._-":
        k -= 1
    j = k
    while j and _letter(text[j - 1]):
        j -= 1
    word = text[j:k]
    if k == at or not word or len(word) == 2:
        return at, "", ""
    if len(word) == 1 and text[k] == ".":
        return (j, word + ".", text[k + 1 : at]) if k + 1 < at else (at, "", "")
    return j, word, text[k:at]


def _formed_names(text: str, names: Names):
    """Names by form and context, whether listed or not."""

    def features(start, end, form, given):
        words = re.findall(r"[^\W\d_]+", text[start:end])
        return _name_features(text, start, end, given, names.score(words[-1])[1] if words else 0.0, form, False, 0)

    for pattern, form in ((_TITLED, 5), (_LABELLED, 6)):
        for m in pattern.finditer(text):
            first = m[1].split()[0].strip(".")
            yield m.start(1), m.end(1), features(m.start(1), m.end(1), form, 1.5 if first.lower() in COMMON_GIVEN else names.score(first)[0])
    for m in _GIVEN_FIRST.finditer(text):
        if m[1].lower().split("-")[0] in COMMON_GIVEN:
            yield m.start(), m.end(), features(m.start(), m.end(), 7, 1.5)
    for pattern, form in ((names.zh_titled, 8), (names.zh_labelled, 9)):
        for m in pattern.finditer(text):
            yield m.start(1), m.end(1), features(m.start(1), m.end(1), form, 0.5)


def _name_features(text: str, start: int, end: int, given: float, family: float, form: int, initial: bool, case: int) -> list:
    left, right = _near(text, start, end)
    cjk = lambda c: "一" <= c <= "鿿"
    return [
        given, family, form, form in (5, 8), form in (6, 9), form == 7, initial, case, text[start : start + 1].isupper(), _has("name_left", left), _has("name_right", right), _has("product_right", right), left[-1:] == "@", left[-1:] == "[", cjk(left[-1:] or " "), cjk(right[:1] or " "),
        bool(re.match(r"[\w.+-]*\s?(?:@|[\[(]at|\(a\))", text[end : end + 12])) , left.rstrip()[-1:] in ("<", ":") and "mailto" in left, "://" in left.rpartition(" ")[2], end - start, not left.strip() and not right.strip(),
    ]


def candidates(text: str, names: Names):
    """(kind, start, end, features) of every span that may be personal information; overlaps are wanted."""
    for start, end, x in _emails(text):
        yield "email", start, end, x
    for start, end, x in _numbers(text):
        yield "phone", start, end, x
        yield "id_number", start, end, x
    for start, end, x in _addresses(text):
        yield "address", start, end, x
    for start, end, x in _names(text, names):
        yield "name", start, end, x


class Redactor:
    """The trained trees of all kinds with the name list."""

    def __init__(self, names: Names, models: dict[str, Boosted]):
        self.names, self.models = names, models

    def spans(self, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
        """The selected (start, end, kind) of each text, without overlaps, in order."""
        rows: dict[str, list] = {k: [] for k in KINDS}
        where: dict[str, list] = {k: [] for k in KINDS}
        for i, t in enumerate(texts):
            if t:
                for kind, start, end, x in candidates(fold(t), self.names):
                    rows[kind].append(x)
                    where[kind].append((i, start, end))
        chosen: list[list] = [[] for _ in texts]
        for kind, x in rows.items():
            if x:
                p = self.models[kind].predict(np.array(x, dtype=np.float64))
                cut = self.models[kind].threshold
                for (i, start, end), q in zip(where[kind], p.tolist()):
                    if q >= cut:
                        chosen[i].append((q, start, end, kind))
        return [self._select(c) for c in chosen]

    @staticmethod
    def _select(found: list[tuple[float, int, int, str]]) -> list[tuple[int, int, str]]:
        """Mail addresses first, then by probability and length, without overlaps."""
        kept: list[tuple[int, int, str]] = []
        for q, start, end, kind in sorted(found, key=lambda x: (x[3] != "email", -round(x[0], 2), x[1] - x[2], x[1])):
            k = bisect_right(kept, (start, end, kind))
            if (k == 0 or kept[k - 1][1] <= start) and (k == len(kept) or kept[k][0] >= end):
                kept.insert(k, (start, end, kind))
        return kept

    def redact(self, text: str, spans: list[tuple[int, int, str]]) -> str:
        out, at = [], 0
        for start, end, kind in spans:
            out += [text[at:start], PLACEHOLDERS[kind]]
            at = end
        return "".join(out) + text[at:]


_TRAINED: dict = {}


def train(parts: list[tuple[str, str, str]], lines: int = TRAIN_LINES, seed: int = 5) -> Redactor:
    """Train the trees on made lines. The same name list and seed give the same trees."""
    key = (tuple(sorted(parts)), lines, seed)
    if key not in _TRAINED:
        from leafmill.llm.personal_training import examples

        rows: dict[str, list] = {k: [] for k in KINDS}
        labels: dict[str, list] = {k: [] for k in KINDS}
        partial, made = examples(parts, lines, seed)
        names = Names(partial)
        for text, gold in made:
            for kind, start, end, x in candidates(fold(text), names):
                good = any(k == kind and start < b and a < end and (kind != "name" or (start >= a - 1 and end <= b + 1)) for a, b, k in gold)
                rows[kind].append(x)
                labels[kind].append(good)
        models = {}
        for kind in KINDS:
            x, y = np.array(rows[kind], dtype=np.float64), np.array(labels[kind])
            held = np.random.default_rng(seed).random(len(y)) < 0.3
            models[kind] = Boosted().fit(x, y, held)
        _TRAINED.clear()
        _TRAINED[key] = Redactor(Names(parts), models)
    return _TRAINED[key]


def name_parts(names: DataFrame) -> list[tuple[str, str, str]]:
    rows = names.select("name_part", "part_kind", "script").where("name_part is not null").distinct().limit(MOST_NAME_PARTS + 1).collect()
    if len(rows) > MOST_NAME_PARTS:
        raise ValueError(f"the name list has more than {MOST_NAME_PARTS} parts")
    return sorted((r[0], r[1], r[2]) for r in rows)


def found_lines(df: DataFrame, key_col: str, text_col: str, names: DataFrame, one_line: bool = False) -> DataFrame:
    """(rec_key, line_no, kind): the lines of each record that hold at least one item of a kind. Each triple once. With ``one_line`` the whole
    text counts as line 1."""
    shared = df.sparkSession.sparkContext.broadcast(train(name_parts(names)))
    rows = spread(df.where(F.col(text_col).rlike(r"\S") & F.col(key_col).isNotNull()).select(F.col(key_col).cast("string").alias("k"), F.col(text_col).alias("t")))

    def run(batches):
        redactor = shared.value
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo in range(0, len(ids), 256):
                keys, numbers, kinds = [], [], []
                for k, text, found in zip(ids[lo : lo + 256], texts[lo : lo + 256], redactor.spans(texts[lo : lo + 256])):
                    ends = [] if one_line else [i for i, c in enumerate(text) if c == "\n"] if found else []
                    for n, kind in sorted({(bisect_right(ends, start - 1) + 1 if not one_line else 1, kind) for start, _, kind in found}):
                        keys.append(k)
                        numbers.append(n)
                        kinds.append(kind)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(numbers, pa.int32()), pa.array(kinds, pa.string())], names=["rec_key", "line_no", "kind"])

    return rows.mapInArrow(run, "rec_key string, line_no int, kind string").distinct()


def redacted(df: DataFrame, key_cols: list[str], text_cols: list[str], names: DataFrame) -> DataFrame:
    """``key_cols`` and ``text_cols`` of every row, with typed placeholders in the texts. Nulls stay null."""
    shared = df.sparkSession.sparkContext.broadcast(train(name_parts(names)))
    columns = [*key_cols, *text_cols]
    picked = df.select(*columns)

    def run(batches):
        redactor = shared.value
        for batch in batches:
            cols = [batch.column(i) for i in range(len(key_cols))]
            for i in range(len(key_cols), len(columns)):
                texts = batch.column(i).to_pylist()
                cols.append(pa.array([t if not t else redactor.redact(t, s) for t, s in zip(texts, redactor.spans(texts))], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, names=columns)

    return picked.mapInArrow(run, picked.schema)
