"""Labelled lines for the trees of :mod:`leafmill.llm.personal`: templates filled with made items, some of them personal."""

from __future__ import annotations

import random
import re

from leafmill.llm.personal import COMMON_GIVEN

#: Share of the name parts that training hides, as the list is incomplete in use too.
HIDDEN_PARTS = 0.25

_ON = ["b", "br", "c", "d", "dr", "f", "g", "gl", "h", "j", "k", "kl", "l", "m", "n", "p", "pl", "qu", "r", "s", "sk", "st", "t", "tr", "v", "w", "z"]
_VO = ["a", "e", "i", "o", "u", "ia", "oa", "ui", "ae", "io"]
_CO = ["", "n", "r", "s", "th", "x", "l", "m"]
_HOSTS = ["example.com", "mail.example.org", "corp.example.net", "staff.example", "wiki.test", "post.invalid", "firma.example.de"]
_ZH_PLACE = "云梧临砚岚港东汐澈州棠溪朔宁青榆江海山湖城新安长平"
#: Sentences about other matters (libraries, choirs, gardens, kitchens): only the slots are personal.
_ZH_TEXT = ["借书证下周统一更换", "合唱排练改到礼堂", "苗圃的水管已经修好", "面团还要醒半小时", "球队明天坐早班车出发", "展柜的灯比去年亮", "下雨时活动移到室内", "门票卖完后还可以登记", "新的琴谱放在柜子里"]
_EN_TEXT = ["the reading room opens late", "rehearsal moves to the hall", "the tulips came up early", "let the dough rest for a while", "the coach leaves at dawn", "tickets sold out fast", "the kiln cooled overnight", "we swapped the two benches"]
_DE_TEXT = ["der Lesesaal öffnet später", "die Probe ist im Festsaal", "die Tulpen blühen schon", "der Teig ruht noch", "der Bus fährt früh ab", "die Karten waren schnell weg", "das Beet wird umgegraben"]

#: {N} name, {F} foreign or common name, {E} mail, {P} phone, {I} identity number, {A} address; all other fields are no personal information.
TEMPLATES = {
    "zh": [
        "借阅联系人：{N}（{P}）", "{W}值守电话：{P}", "> 电话 {P}（{W}）", "报名请联系{N}，手机 {P}，邮箱 {E}。", "领队：{N}，身份证号 {I}，第{n}组。", "{t}。证件号 {I} 已登记。", "护照号码：{I}", "> {N}（{W}）", "> {W} · {E}",
        "{N} 说：{t}。", "{N}（{n} 楼）回复：{t}。", "* {N} · {n} 天前：{t}。", "@{N} 请下周带上{W}的钥匙。", "由 [{N}](http://club-{x}.example.com/{x}/display/~{x}) 创建, 最后修改于 [三月 02, 2021](http://club.example.com/{x})",
        "* 由 [{N}](http://club.example.com/{x}/display/~{x}", "由 [{N}](http://club.example.com/display/~{x})创建于[五月 11, 2020](http://club.example.com/{x})", "| {N} | {E} | {W}队 |", "{t}。（记录人：{N}）", "{N}在排练时提到，{t}。", "{W}的奖杯已寄往{A}，收件人{N}。",
        "{W}乐谱寄送地址：{A}", "> {W}活动室，{A}", "{W}出库单号 {S}，第 {n} 箱，已签收。", "版权所有 © {Y} {W}", "{W} 小程序 {D} 自动生成，请勿修改。", "{W} 系统版本 {V}，共 {n} 页", "用 {W} 排字机 {V} 印制", "由 {W}-timer 设备于 {D} 清洗，请勿打开。", "{W} 网关 {n} 端口对应 {IP}。",
        "{Z}路项目（代号 {W}）并入 {W}。", "{z}街改造工程分{n}期，{W}先行。", "{G} 连接器与 {W} 的版本为 {v}。", "代码库 git@code.example.com:{x}/{x}.git", "{x}@2x.png 存于 {x}/img。", "目录（{n}） http://club.example.com/pages/list.action?pageId={n9}", "{t}，{t}。", "以{Z}小组与木工组商定的{W}尺寸为准。",
        "{Z}项目的花名册由{W}组保管。", "{Z}送来的{n}件展品里，{W}占一半。", "请各组核对{Z}的座位表，再查{W}的{n}行。", "{Z}环境中的{W}每天备份。", "已读 {n9} 次，约 {n} 分钟", "见第 {n} 页", "订单号 {n9}", "若{W}没开门，请照{Z}版说明办理。",
        "[WARN] {W} mail to {E} bounced, code={n}", "值守{P}", "手机：{P}", "住址：{A}", "姓名：{F}", "{F}先生{t}。", "请找{F}老师。", "联系人：{F}，{P}",
    ],
    "en": [
        "* {W} contact: {N}, {P}", "{W} helpline number {P}", "M ({W}): {P}", "To book {W} ask {N} at {P} or {E}.", "{W} entry form: {N}, SSN {I}", "{t}. The passport shown was {I}.", "Passport no. {I} belongs to {N}.", "{N}, {W}", "{N} says: {t}.", "{N} replied #{n} - {t}.", "* {N}, {n} days ago: {t}.",
        "@{H} please bring {W} on Sunday.", "By {N} | Jan 12, 2015 | /x/{x}", "{N} · updated Jan 12, 2015 · {x}", "Created by {N}, last modified on May 07, 2022 ({x})", "| {N}, {W} | {E} |", "{t}. (notes by {N})", "{N} remarked that this was so: {t}.", "The {W} trophy was sent to {N}, {A}.",
        "Post the {W} score to {A}", "{W}, {A}", "{W} desk - {E}", "{E} ({W})", "[WARN] {W} mail to {E} bounced, code={n}", "2021-06-01 WARN {W} smtp: rcpt <{E}> refused", "> {W} · {E}", "Serial {S} was stamped on {W}, see {W}.", "© {Y} {W}", "Made on {D} by {W}-bot.", "Brewed by {W} Kitchen {V}", "Run by {w} {w} since {n}",
        "{W} Player {V}", "Typeset with {W} Press {V}", "Last rinsed on {D} by {W}-timer, do not open.", "Node {IP} runs {W} on port {n} for {W}.", "The {W} Street track of {W} ends with {W}.", "The {W} Road project has {n} stops.", "{W} Avenue team met {W}.", "The {G} connector feeds {W} into {W}.", "Fetch git@code.example.com:{x}/{x}.git first.", "{W} cover {x}@3x.png was redrawn.", "Pair {x}@{v} with {W}.",
        "{n} min walk, {n} seats", "{W} Quick guides are {W} only", "{w} pages are {w} by design", "{t}, {t}.", "We packed {n} boxes for {W}, {n} of them by {W}.", "[Files ({n})](http://club.example.com/pages/list.action?pageId={n9})", "Order {n9} was packed", "Call {P}", "Kind regards,", "Show again in {n} days", "{W} Works sells {W}", "The {W} pass lapses after {n} minutes",
        "Mr. {F} met {F}.", "Dr. {F} and Ms. {F}: {t}.", "Best, {F}", "Regards,\n{F}", "Regards,\n{W} Team", "Contact: {W} Office", "Contact: {F}", "{F} wrote that {t}.", "Signed by {F} for {W}.", "Thanks to {F}, {t}.",
    ],
    "de": [
        "* Ansprechperson {W}: {N} ({P})", "Telefon {W}: {P}", "Notruf {W}: {P}", "Zu {W} bitte {N} fragen, Tel. {P}, {E}.", "Anmeldung {W}: {N}, Ausweisnr. {I}", "{t}. Vorgelegt wurde der Ausweis {I}.", "{N}, {W}", "{N} schreibt: {t}.", "{N} meinte dazu: {t}.", "* {N}, vor {n} Tagen: {t}.", "@{H} bitte {W} am Sonntag mitbringen.",
        "Von {N} angelegt, zuletzt geändert am 03.02.2016 (Kürzel {x})", "| {N}, {W} | {E} |", "{t}. (Protokoll: {N})", "Die Noten zu {W} gingen an {N}, {A}.", "Postanschrift für {W}: {A}", "{W}, {A}", "{E} ({W})", "Rücksendung {W}: {E}", "Vorgang {S} zu {W} ist erledigt.", "© {Y} {W}",
        "Am {D} durch {W}-Zähler erstellt.", "{W} Spieler {V}", "Gesetzt mit {W} Satz {V}", "Gebacken mit {W} Ofen {V}", "Zuletzt gespült am {D} durch {W}-Uhr, bitte nicht öffnen.", "{W}: Teil-Nr. {T} gehört zu {W}.", "Das Projekt {w}straße heißt nun {W} statt {W}.", "Das Vorhaben {w}weg ruht.", "{W} braucht {x}@{v}.", "git@code.example.com:{x}/{x}.git holen", "Gehzeit: etwa {n} Minuten, {n} Plätze",
        "Der Schein von {W} gilt {n} Tage in {W}.", "{t}, {t}.", "Gepackt wurden {n} Kisten für {W}, davon {n} von {W}.", "Der {G}-Adapter passt zu {W}.", "Viele Grüße", "Auf dem Weg {n} kam {W} an", "[Dateien ({n})](http://club.example.com/pages/list.action?pageId={n9})",
        "Herr {F} traf Frau {F}.", "Viele Grüße,\n{F}", "Grüße\n{W} Gruppe", "Autorin: {F}", "{F} sagt: {t}.",
    ],
    "author": [
        "{N}", "{N}", "{N}", "{N} <{E}>", "{E}", "{N}/{P}", "{N} [{I}]", "{N}, {A}", "{N}（木工组）", "{N} {n4}", "  {N} ", "{R}", "{L}", "u{n}", "Author {n}", "import-bot 2", "club-sync", "admin", "Garden Team", "系统管理员", "资料组", "佚名", "{G} Connector", "{W} Docs", "Redaktion Süd", "{Z}小组", "{F}", "{U}",
    ],
}

#: Given names that are words too.
_WORD_GIVEN = "Rose Dawn Hope Grant Mark Rich Jasper Autumn River Sage Ivy Brook Dale Forest Heather Joy".split()
#: Family names, and Chinese given names, that aren't in any list the features know.
_FOREIGN_FAMILY = "Smith Garcia Merkel Johnson Novak Rossi Tanaka Kowalski O'Connor Lindqvist Okafor Dubois Yilmaz Petrov Haddad Nguyen Schneider Fischer Weber Hoffmann Brown Taylor Lopez Silva Moreau Larsen".split()
_ZH_FOREIGN = ["伟", "建国", "秀英", "晓明", "丽", "志强", "雪梅", "浩然", "敏", "子涵"]


class Maker:
    def __init__(self, parts: list[tuple[str, str, str]], seed: int):
        self.r = random.Random(seed)
        pick = lambda kind, script: sorted({p for p, k, s in parts if k == kind and s == script}) or ["Nomen"]
        self.given, self.family = pick("given", "latin"), pick("family", "latin")
        self.zh_given = [g for g in pick("given", "zh") if len(g) == 2] or ["文远"]
        self.zh_family = [*[f for f in pick("family", "zh") if not f.isascii()], "钟离", "欧阳", "司徒", "逯", "宓", "厍", "闾丘", "漆雕"]

    def digits(self, n: int, first: str = "0123456789") -> str:
        return self.r.choice(first) + "".join(self.r.choice("0123456789") for _ in range(n - 1)) if n else ""

    def word(self) -> str:
        w = lambda: "".join(self.r.choice(_ON) + self.r.choice(_VO) + self.r.choice(_CO) for _ in range(self.r.randint(1, 3))).capitalize()
        return self.r.choice(["{a}", "{a} {b}", "{a}-{b}", "{a}/{b}"]).format(a=w(), b=w())

    def name(self, language: str) -> str:
        if language == "zh" and self.r.random() < 0.7 or language == "author" and self.r.random() < 0.45:
            family, given = self.r.choice(self.zh_family), self.r.choice(self.zh_given)
            full = family + given
            k = self.r.randint(1, len(full) - 1)
            return full if self.r.random() < 0.9 else full[:k] + " " + full[k:]
        given, family = self.r.choice(self.given), self.r.choice(self.family)
        form = self.r.random() if language == "author" else 0.0
        return f"{given} {family}" if form < 0.6 else f"{family}, {given}" if form < 0.75 else f"{given[0]}. {family}" if form < 0.88 else f"{given} {family}".lower()

    def foreign(self, language: str) -> str:
        if language == "zh":
            return self.r.choice("张王李赵刘陈杨黄周吴徐孙马朱胡郭何高林罗") + self.r.choice(_ZH_FOREIGN)
        given = self.r.choice(sorted(COMMON_GIVEN)).capitalize()
        return self.r.choice(["{g} {f}"] * 4 + ["{g} {i}. {f}", "{g}-{h} {f}"]).format(g=given, f=self.r.choice(_FOREIGN_FAMILY), i=self.r.choice("ABCDEFGHJKLM"), h=self.r.choice(["Marie", "Peter"]))

    def email(self) -> str:
        given, family = self.r.choice(self.given).lower(), self.r.choice(self.family).lower().replace("ö", "oe")
        n = self.digits(self.r.randint(1, 2))
        local = self.r.choice([given + n, f"{given}.{family}", f"{given}-{family}{n}", f"{family}_{given[0]}", given[0] + family, f"{given}.{family}+wiki", "info", "support", "office" + n])
        host = self.r.choice(_HOSTS)
        full = self.r.choice(["{l}@{h}"] * 5 + ["{l} [at] {h}", "{l}(at){d}", "{l}＠{h}", "[{l}@{h}](mailto:{l}@{h})"]).format(l=local, h=host, d=host.replace(".", " dot "))
        return full.upper() if self.r.random() < 0.12 and "mailto" not in full else full

    def phone(self, language: str) -> str:
        d = self.digits
        if language == "zh":
            m = "1" + d(2, "35678") + " " + d(4) + " " + d(4)
            a, b, c = m.split()
            out = self.r.choice([a + b + c, f"{a}-{b}-{c}", f"+86 {a} {b} {c}", f"+86-{a}{b}{c}", f"0086{a}{b}{c}", f"({a}){b} {c}", f"0{d(2)}-{d(8)}"])
            return "".join(chr(ord(c) + 0xFEE0) if c.isdigit() and self.r.random() < 1 else c for c in out) if self.r.random() < 0.1 else out
        if language == "en":
            a = d(3, "23456789")
            return self.r.choice([f"555-01{d(2)} (ext. {d(3)})", f"({a}) 555-01{d(2)}", f"+1 {a} 555 01{d(2)}", f"+1-{a}-555-01{d(2)}", f"{a}.555.01{d(2)}", f"{a}-555-01{d(2)}", f"+44 20 7946 0{d(3)}", f"020 7946 0{d(3)}"])
        return self.r.choice([f"030/{d(8)}", f"(030) {d(5)} {d(3)}", f"030 {d(5)} {d(3)}", f"+49 30 {d(5)}-{d(3)}", f"+49 (0)30 {d(5)} {d(3)}", f"0171 {d(7)}", f"0049 171 {d(5)} {d(2)}"])

    def identity(self, language: str) -> str:
        d = self.digits
        if language == "zh":
            day = f"{self.r.randint(1940, 2010)}{self.r.randint(1, 12):02d}{self.r.randint(1, 28):02d}"
            tail = d(3) + self.r.choice("0123456789X")
            return self.r.choice([f"{d(6, '123456789')}{day}{tail}"] * 3 + [f"{d(6, '123456789')} {day} {tail}", f"{d(6, '123456789')}-{day}-{tail}"])
        if language == "en":
            mixed = self.r.choice("CFGHJKLMNPRTVWXYZ") + "".join(self.r.choice("CFGHJKLMNPRTVWXYZ0123456789") for _ in range(5)) + d(3)
            return self.r.choice([mixed, f"9{d(2)}-{d(2)}-{d(4)}", f"{d(3, '123456789')} {d(2)} {d(4)}", d(9, "123456789"), f"{d(3, '123456789')}-{d(2)}-{d(4)}"])
        return self.r.choice([f"ZZ{d(7)}", f"ZZ {d(3)} {d(4)}", f"L{d(8)}", f"C {d(3)} {d(4)}", self.r.choice("CFGHJK") + d(2) + self.r.choice("CFGHJKLMNPRTVWXYZ") + d(2) + self.r.choice("CFGHJKLMNPRTVWXYZ") + d(2)])

    def address(self, language: str) -> str:
        r = self.r
        if language == "zh":
            z = lambda n: "".join(r.choice(_ZH_PLACE) for _ in range(n))
            area = r.choice(["", "", f"{z(2)}市{z(2)}区", f"{z(2)}省{z(2)}市"])
            return area + z(2) + r.choice(["路", "街", "巷", "大道"]) + str(r.randint(1, 500)) + r.choice(["号", f"号{r.randint(1, 9)}栋{r.randint(1, 2200)}室", f"弄{r.randint(1, 30)}号楼"])
        w = self.word().split()[0].split("-")[0].split("/")[0]
        if language == "en":
            road = f"{r.choice(['', '', f'Flat {r.randint(1, 30)}, '])}{r.randint(1, 500)} {w} {r.choice(['Road', 'Street', 'Avenue', 'St.', 'Ave.', 'Rd', 'Lane'])}"
            return road + r.choice(["", f", {w}field", f", Apt {r.randint(1, 40)}{r.choice('ABC')}", f", {w}ton {self.digits(5, '123456789')}"])
        road = r.choice([f"{w}straße", f"{w}weg", f"Am {w}", f"{w}str.", f"{w}gasse"])
        return f"{road} {r.randint(1, 480)}{r.choice(['', '', 'a', 'b'])}" + r.choice(["", f", {self.digits(5)} {w}au", f", {w}rode"])

    def fill(self, language: str) -> tuple[str, list[tuple[int, int, str]]]:
        r = self.r
        template = r.choice(TEMPLATES[language])
        own = language if language != "author" else r.choice(["zh", "en", "de"])
        texts = {"zh": _ZH_TEXT, "en": _EN_TEXT, "de": _DE_TEXT}[own]
        kinds = {"N": "name", "F": "name", "H": "name", "R": "name", "U": "name", "L": "name", "E": "email", "P": "phone", "I": "id_number", "A": "address"}
        out, gold, at = "", [], 0
        for m in re.finditer(r"\{(\w+)\}", template):
            out += template[at : m.start()]
            at = m.end()
            f = m[1]
            given, family = r.choice(self.given), r.choice(self.family)
            value = {
                "N": lambda: self.name(language), "H": lambda: r.choice([f"{given}{family}", f"{given}.{family}", f"{given} {family}"]), "R": lambda: f"{family}, {given}", "U": lambda: f"{family}, {r.choice(_WORD_GIVEN)}", "L": lambda: f"{given} {family}".lower(), "E": self.email,
                "F": lambda: self.foreign(own), "w": lambda: re.split("[ /-]", self.word())[0], "z": lambda: "".join(r.choice(_ZH_PLACE) for _ in range(2)), "P": lambda: self.phone(own), "I": lambda: self.identity(own), "A": lambda: self.address(own), "W": self.word, "t": lambda: r.choice(texts), "x": lambda: self.word().lower().replace(" ", "_").replace("/", "-"), "n": lambda: str(r.randint(1, 4000)),
                "n4": lambda: self.digits(4), "n9": lambda: self.digits(9, "123456789"), "S": lambda: self.digits(18, "123456789"), "V": lambda: r.choice([f"{r.randint(1, 9)}.{r.randint(1, 20)}.{r.randint(0, 9)}", f"{self.digits(r.randint(2, 4))}.{self.digits(4)}.{self.digits(r.randint(3, 4))}"]),
                "v": lambda: f"{r.randint(0, 9)}.{r.randint(0, 40)}.{r.randint(0, 90)}", "D": lambda: r.choice(["2024-03-05", "05.03.2024", f"{self.digits(4)}-{self.digits(4)}-{self.digits(4)}", f"{self.digits(3)}-{self.digits(4)}-{self.digits(4)}", f"{self.digits(3)}.{self.digits(4)}.{self.digits(4)}"]),
                "Y": lambda: r.choice(["2011-2025", "2012–2025", f"{self.digits(4)}-{self.digits(4)}", f"{self.digits(3)}-{self.digits(4)}", f"{self.digits(4)}–{self.digits(3)}"]), "T": lambda: f"{self.digits(3)}-{self.digits(2)}-{self.digits(r.randint(2, 3))}",
                "IP": lambda: ".".join(str(r.randint(1, 254)) for _ in range(4)), "G": lambda: r.choice(self.given), "Z": lambda: r.choice(self.zh_given),
            }[f]()
            if f in kinds:
                gold.append((len(out), len(out) + len(value), kinds[f]))
            out += value
        return out + template[at:], gold


def examples(parts: list[tuple[str, str, str]], lines: int, seed: int) -> tuple[list[tuple[str, str, str]], list[tuple[str, list[tuple[int, int, str]]]]]:
    """(the name parts that the features may know in training, labelled lines)."""
    maker = Maker(parts, seed)
    known = [p for p in parts if maker.r.random() > HIDDEN_PARTS]
    out = []
    for i in range(lines):
        text, gold = maker.fill(("zh", "en", "de", "author")[i % 4])
        if maker.r.random() < 0.06:
            text = text.replace(" ", "\xa0")
        elif maker.r.random() < 0.05 and len(text.upper()) == len(text):
            text = text.upper()
        out.append((text, gold))
    return known, out
