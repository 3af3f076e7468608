"""Personal information in text of other making than the training lines and the test data, and the absence of length limits."""

import re

from leafmill.llm import personal

PARTS = [("Aldane", "given", "latin"), ("Brandwick", "family", "latin"), ("砚舟", "given", "zh"), ("澹台", "family", "zh")]

#: Marked text: <kind:text>. None of these sentences or names occur in the training lines.
FOREIGN = """Mr. <name:Gregor Samsa> woke up one morning and called <phone:+49 89 3456-7781>.
Dear Dr. <name:Helena Vasquez>, your appointment is on 2024-05-01 at 10:30.
Please write to <email:h.vasquez@clinic.example> or ring <phone:(212) 555-0147>.
Best, <name:Victoria Ashdown>
The lease was signed by <name:Martin Oyelaran> and <name:Karen Whitfield>.
Parcel for <name:Daniel Kovacs>, <address:48 Willow Lane>
Passport <id_number:C01X00T47> was stamped twice.
Her social security number is <id_number:219-09-9999>.
Frau <name:Ursula Niemeyer> wohnt in der <address:Lindenstraße 14, 50674 Köln>.
Bitte melden Sie sich bei Herrn <name:Otto Brandauer> unter <phone:030 5557 8812>.
Ansprechpartnerin: <name:Katharina Vogt>
Ausweis <id_number:L01X00T47> geprüft, Versand an <address:Am Rosengarten 7>.
姓名：<name:张建华>
请联系<name:王小明>先生，手机 <phone:13912345678>。
身份证号 <id_number:110101199003074578> 已核验。
快递寄往<address:朝阳区建国路88号>，谢谢。
Minutes: <name:Charlotte Duval> moved, <name:Oliver Tran> seconded.
Contact: <name:Samuel Eriksen>, <email:sam.eriksen@museum.example>
mail <email:office [at] museum.example> for tickets
Attendee: <name:Laura Bianchi>"""
PLAIN = """Version 4.12.7 was released on 2023-11-05.
The Elm Street project team moved to Building 4.
Order 884512390 shipped in 3 boxes.
See RFC 2822 section 3.4 and ISO 8601-1:2019.
The ratio is 3.14159 and the port is 8080.
Copyright 2015-2024 Harbour Systems
Clone git@code.example.org:tools/build.git first.
Image logo@2x.png is 240 by 160 pixels.
The Grafana connector reads from Apache Kafka.
Kind regards,"""


def marked(text):
    out, gold, at = "", [], 0
    for m in re.finditer(r"<(\w+):([^>]*)>", text):
        out += text[at : m.start()]
        gold.append((len(out), len(out) + len(m[2]), m[1]))
        out += m[2]
        at = m.end()
    return out + text[at:], gold


def test_foreign_text():
    redactor = personal.train(PARTS)
    lines = [marked(x) for x in FOREIGN.split("\n")]
    hits = total = found_ones = 0
    missed = []
    for (text, gold), found in zip(lines, redactor.spans([t for t, _ in lines])):
        for a, b, kind in gold:
            ok = any(k == kind and s < b and a < e for s, e, k in found)
            hits += ok
            total += 1
            missed += [] if ok else [(text, text[a:b])]
        found_ones += len(found)
    assert hits / total >= 0.9, missed
    assert hits / found_ones >= 0.9
    plain = redactor.spans(PLAIN.split("\n"))
    assert sum(map(len, plain)) <= 1, plain


def test_no_length_limits():
    redactor = personal.train(PARTS)
    road = "12 " + "Verylongroadnamethatgoeson" * 4 + " Street"
    name = "Aldane" + " " * 60 + "Brandwick"
    texts = [f"Ship it to {road}", f"contact: {name}, office", "x" * 200_000 + " call +1 212 555 0147", "a " * 50_000 + "Aldane Brandwick says: hello"]
    kinds = [{k for _, _, k in found} for found in redactor.spans(texts)]
    assert kinds[0] == {"address"} and "name" in kinds[1] and kinds[2] == {"phone"} and "name" in kinds[3]
    names = personal.Names(PARTS)
    sizes = {len(re.sub(r"\D", "", t)) for t in ("ring 112-45", "4" * 40) for k, a, b, _ in personal.candidates(t, names) if k == "phone"}
    assert sizes == set() or 40 in sizes


def test_selection_is_without_overlaps():
    found = [(0.9, i, i + 5, "name") for i in range(0, 3000, 2)] + [(0.99, 11, 13, "email")]
    kept = personal.Redactor._select(found)
    assert (11, 13, "email") in kept and all(a[1] <= b[0] for a, b in zip(kept, kept[1:]))
