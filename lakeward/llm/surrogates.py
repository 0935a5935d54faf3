"""Personal data replaced by keyed surrogates.

Detected entities get replacements that are computed from a secret key, the
entity's type and its canonical form, so one entity has one surrogate wherever
and however it is written.  A surrogate keeps the type (a card number passes
its check digit, an address is a valid address), a name's gender and script,
and the mention's format: separators, grouping, country code, upper or lower
case.  The distinct entities of the whole corpus are checked against each
other: no two may share a surrogate, and no surrogate may be an entity of the
corpus; whoever loses tries again with the next attempt, in rounds of joins.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.shared import cut

# Titles with the gender they tell, and names' syllables and endings by script and gender.
TITLES = {
    "m": "Mr Mister Sir Herr Monsieur Señor Sr Signor господин κύριος".split(),
    "f": "Mrs Ms Miss Madam Frau Mme Madame Mlle Señora Señorita Sra Signora госпожа κυρία".split(),
    "n": "Dr Prof Professor".split(),
}
GIVEN = {
    "m": """James John Robert Michael William David Richard Joseph Thomas Charles Daniel Paul Mark George Peter Hans Klaus
Jürgen Wolfgang Pierre Jean Jacques Michel Luis Carlos José Juan Miguel Иван Пётр Сергей Андрей Γιώργος Νίκος""".split(),
    "f": """Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Anna Emma Laura Julia Ursula Monika
Petra Sabine Marie Sophie Claire Isabelle María Carmen Ana Lucía Анна Мария Елена Ольга Ελένη Κατερίνα""".split(),
}
SYLLABLES = {
    "latin": "ba be bo da de di do fa fe ga go ha he jo ka ke ki ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi wa we za".split(),
    "cyrillic": "ба бе бо ва ве ви га го да де ди до жа за ка ке ко ла ле ли ло ма ме ми мо на не ни но па пе ра ре ри ро са се си со та те ти то фа ха ша".split(),
    "greek": "βα βε γα γε δα δε δι ζα θα θε κα κε κο λα λε λι λο μα με μι μο να νε νι νο πα πε ρα ρε ρι ρο σα σε σι σο τα τε τι το φα φι χα".split(),
}
ENDINGS = {
    ("latin", "m"): "nan nor ren mus rik ton".split(), ("latin", "f"): "na ria lina belle rine sia".split(),
    ("latin", "n"): "ler mann son field ner ward".split(),
    ("cyrillic", "m"): "дан мир слав тор".split(), ("cyrillic", "f"): "на рия лина да".split(),
    ("cyrillic", "n"): "нко чук вич ский".split(),
    ("greek", "m"): "νος ρης λος κος".split(), ("greek", "f"): "να ρια λια ση".split(),
    ("greek", "n"): "ίδης άκης όπουλος άτος".split(),
}
HAN_FAMILY = "王李张刘陈杨赵黄周吴徐孙胡朱高林何郭马罗"
HAN_GIVEN = {"m": "伟强磊军勇杰涛明超刚建国志文博宇浩然子轩", "f": "芳娜敏静丽艳娟霞秀英玉兰雪梅婷慧琳欣怡佳",
             "n": "安宁平和中正乐清和一天然心远可以新成希"}

WORD = r"[A-ZÀ-ÖØ-ÞА-ЯЁΑ-ΫΆΈΉΊΌΎΏ][\w'’-]*"
TITLE_OF = {t: g for g, titles in TITLES.items() for t in titles}
GENDER_OF = {n.lower(): g for g, names in GIVEN.items() for n in names}
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# One pattern a kind; each may only begin where a word or number begins, so that long runs are read once.
PATTERNS = {
    "email": re.compile(r"(?<![\w.%+-])[A-Za-z0-9_][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-])"),
    "ip": re.compile(rf"(?<![\w.]){OCTET}(?:\.{OCTET}){{3}}(?![\w]|\.\d)"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "card": re.compile(r"(?<![\w.-])\d(?:[\x20-]?\d){12,18}(?![\w-])"),
    "phone": re.compile(r"(?<![\w+.-])(?:\+\d{1,3}[\x20.-]?)?(?:\(\d{2,4}\)[\x20.-]?|\d{2,4}[\x20.-])\d{3,4}[\x20.-]\d{3,4}(?![\w-])"),
    "name": re.compile(rf"(?<!\w)(?:(?P<title>{'|'.join(sorted(TITLE_OF, key=len, reverse=True))})\.?\x20(?P<names>{WORD}(?:\x20{WORD}){{0,2}})"
                       rf"|(?P<given>{'|'.join(n for names in GIVEN.values() for n in names)})\x20(?P<family>{WORD}))(?!\w)"),
    "han": re.compile(rf"(?P<han>[{HAN_FAMILY}][一-鿿]{{1,2}})(?P<gender>先生|女士|小姐)"),
}
HAN_GENDER = {"先生": "m", "女士": "f", "小姐": "f"}


def luhn(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def script(word: str) -> str:
    c = next((c for c in word if c.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= c <= "ӿ" else "greek" if "Ͱ" <= c <= "Ͽ" else "latin"


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form), disjoint, by start.

    Kinds: email, ip, iban, ssn, card, phone, and for names given:<script>:<gender>,
    family:<script> and person:han:<gender>.  Of overlapping matches the one
    that starts first counts, then the longest.  A family name found with a
    title or given name is also found where it stands alone."""
    found = []
    for kind, pattern in PATTERNS.items():
        if kind == "email" and "@" not in text:
            continue
        for m in pattern.finditer(text):
            value = m[0]
            digits = re.sub(r"\D", "", value)
            if kind == "email":
                found.append((m.start(), m.end(), kind, value.lower()))
            elif kind == "card":
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), m.end(), kind, digits))
            elif kind == "phone":
                if len(digits) >= 9:
                    found.append((m.start(), m.end(), kind, digits[-10:]))
            elif kind == "iban":
                plain = value.replace(" ", "")
                if 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                    found.append((m.start(), m.end(), kind, plain))
            elif kind == "name":
                found += name_parts(m)
            elif kind == "han":
                found.append((m.start("han"), m.end("han"), f"person:han:{HAN_GENDER[m['gender']]}", m["han"]))
            else:
                found.append((m.start(), m.end(), kind, digits if kind == "ssn" else value))
    families = {c: k for _, _, k, c in found if k.startswith("family")}
    if families:
        for m in re.finditer(WORD, text):
            if m[0].lower() in families:
                found.append((m.start(), m.end(), families[m[0].lower()], m[0].lower()))
    out: list[tuple[int, int, str, str]] = []
    for e in sorted(found, key=lambda e: (e[0], -e[1], e[2])):
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


def name_parts(m: re.Match) -> list[tuple[int, int, str, str]]:
    """Given and family names of a match; one name behind a title is a family name."""
    at, words = (m.start("names"), m["names"]) if m["title"] else (m.start("given"), f"{m['given']} {m['family']}")
    parts, out = words.split(" "), []
    gender = TITLE_OF.get(m["title"] or "", "n")
    if gender == "n":
        gender = GENDER_OF.get(parts[0].lower(), "n")
    for i, part in enumerate(parts):
        last = i == len(parts) - 1
        kind = f"family:{script(part)}" if last else f"given:{script(part)}:{gender}"
        out.append((at, at + len(part), kind, part.lower()))
        at += len(part) + 1
    return out


class Draw:
    """Numbers drawn from a key and a message, the same each time."""

    def __init__(self, key: bytes, *message):
        self.key, self.message = key, "\x1f".join(map(str, message)).encode("utf-8", "surrogatepass")
        self.value, self.size, self.n = 0, 1, 0

    def below(self, n: int) -> int:
        while self.size < n << 32:
            block = hmac.digest(self.key, self.message + b"\x1f%d" % self.n, hashlib.sha256)
            self.value, self.size, self.n = self.value << 256 | int.from_bytes(block), self.size << 256, self.n + 1
        self.value, r = divmod(self.value, n)
        self.size //= n
        return r

    def pick(self, items):
        return items[self.below(len(items))]


def surrogate(key: bytes, kind: str, canon: str, attempt: int = 0) -> str:
    """The canonical form that replaces ``canon``.  Later attempts draw anew,
    from a larger set where the first is small, so that some attempt is free."""
    draw = Draw(key, kind, canon, attempt)
    more = attempt // 4
    if kind == "email":
        local, _, domain = canon.partition("@")
        vowels, others = "aeiou", "bcdfghjklmnpqrstvwxyz"
        local = "".join(draw.pick(vowels) if c in vowels else draw.pick(others) if c.isalpha()
                        else str(draw.below(10)) if c.isdigit() else c for c in local)
        local += "".join(str(draw.below(10)) for _ in range(more))
        own = Draw(key, "domain", domain)   # addresses of one domain stay together
        name = "".join(own.pick(others) + own.pick(vowels) for _ in range(4))
        return f"{local}@{name}.example.{own.pick(['com', 'org', 'net'])}"
    if kind == "ip":                        # 10/8 stays private, the rest goes to the unused 240/4
        first = canon.split(".")[0]
        return ".".join(map(str, [10 if first == "10" else 240 + draw.below(15) if more < 2 else 1 + draw.below(254)]
                            + [draw.below(256) for _ in range(2)] + [1 + draw.below(254)]))
    if kind == "card":
        body = canon[0] + "".join(str(draw.below(10)) for _ in canon[1:-1])
        return next(body + d for d in "0123456789" if luhn(body + d))
    if kind == "phone":
        return str(2 + draw.below(8)) + "".join(str(draw.below(10)) for _ in canon[1:])
    if kind == "ssn":                       # numbers from 900 on are never given out
        return "9" + "".join(str(draw.below(10)) for _ in canon[1:])
    if kind == "iban":
        body = "".join(str(draw.below(10)) if c.isdigit() else chr(65 + draw.below(26)) for c in canon[4:])
        check = 98 - int("".join(str(int(c, 36)) for c in body + canon[:2] + "00")) % 97
        return f"{canon[:2]}{check:02d}{body}"
    what, writing, *gender = kind.split(":")
    if what == "person":
        return draw.pick(HAN_FAMILY) + "".join(draw.pick(HAN_GIVEN[gender[0]]) for _ in range(len(canon) - 1 + more))
    return ("".join(draw.pick(SYLLABLES[writing]) for _ in range(2 + more))
            + draw.pick(ENDINGS[writing, gender[0] if gender else "n"]))


def render(value: str, mention: str, kind: str, canon: str) -> str:
    """A surrogate in the format of the mention that it replaces."""
    if kind in ("card", "phone", "ssn", "iban"):
        plain = [i for i, c in enumerate(mention) if c.isalnum()]
        out = list(mention)
        for i, c in zip(plain[len(plain) - len(value):], value):
            out[i] = c
        return "".join(out)
    letters = [c for c in mention if c.isalpha()]
    if letters and mention == mention.upper() and mention != mention.lower():
        return value.upper()
    return value[:1].upper() + value[1:] if mention[:1].isupper() else value


def _row(frame: DataFrame) -> list:
    return [F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", "doc_id").alias("k2")]


def mentions(docs: DataFrame) -> DataFrame:
    """The distinct entities of every row: ``k1, k2`` (the row's key), ``kind``, ``canon``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(a, c, kind, canon) for a, c, text in zip(b["k1"], b["k2"], b["text"]) if text
                    for kind, canon in dict.fromkeys(e[2:] for e in entities(text))]
            yield pd.DataFrame(rows, columns=["k1", "k2", "kind", "canon"])
    return docs.select(*_row(docs), "text").mapInPandas(run, "k1 long, k2 long, kind string, canon string")


def attempts(found: DataFrame, key: bytes) -> DataFrame:
    """The entities (``kind``, ``canon``) whose surrogate is not the first drawn,
    with the ``attempt`` that gives theirs.

    Each round, all entities without a surrogate draw one.  Of those that draw
    the same the smallest keeps it, unless the corpus has such an entity or an
    earlier round gave it away; the others go to the next round."""
    @F.pandas_udf("string")
    def draw(kind: pd.Series, canon: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, c, int(a)) for k, c, a in zip(kind, canon, attempt)], dtype=object)
    every = cut(found.select("kind", "canon").distinct(), "entities")
    left, taken, late, attempt = every, None, None, 0
    while True:
        drawn = cut(left.withColumn("attempt", F.lit(attempt)).withColumn("drawn", draw("kind", "canon", "attempt")), "drawn")
        first = drawn.groupBy("kind", "drawn").agg(F.min("canon").alias("canon"))
        free = first.join(every.withColumnRenamed("canon", "drawn"), ["kind", "drawn"], "left_anti")
        if taken is not None:
            free = free.join(taken, ["kind", "drawn"], "left_anti")
        given = cut(free, "given")
        names = given.select("kind", "drawn")
        taken = names if taken is None else taken.unionAll(names)
        if attempt:
            done = given.select("kind", "canon", F.lit(attempt).alias("attempt"))
            late = done if late is None else late.unionAll(done)
        left = cut(drawn.join(given, ["kind", "canon"], "left_anti").select("kind", "canon"), "left")
        attempt += 1
        if left.isEmpty():
            return late if late is not None else left.withColumn("attempt", F.lit(0))


def replace(docs: DataFrame, key: bytes) -> DataFrame:
    """``doc_id``, ``text`` with all entities replaced, ``n_replaced`` and ``spans``
    (kind:start:end of the entities in the old text, code points, end exclusive).

    A null text stays null and has no spans; repeated rows each give a row, all
    alike.  The entities are sparse: only they, and per row those few whose
    surrogate is not the first drawn, are shuffled, and these are joined to
    the texts."""
    found = cut(mentions(docs), "mentions")
    late = attempts(found, key)
    exceptions = cut(found.join(late, ["kind", "canon"]).groupBy("k1", "k2").agg(
        F.collect_list(F.struct("kind", "canon", "attempt")).alias("late")), "exceptions")

    @F.pandas_udf("text string, n_replaced long, spans string")
    def run(texts: pd.Series, lates: pd.Series) -> pd.DataFrame:
        rows = []
        for text, late_ones in zip(texts, lates):
            tries = {(x["kind"], x["canon"]): x["attempt"] for x in late_ones} if late_ones is not None else {}
            spans = entities(text) if text else []
            out, at = [], 0
            for start, end, kind, canon in spans:
                value = surrogate(key, kind, canon, tries.get((kind, canon), 0))
                out += [text[at:start], render(value, text[start:end], kind, canon)]
                at = end
            rows.append((None if text is None else "".join(out) + text[at:], len(spans),
                         ",".join(f"{k}:{s}:{e}" for s, e, k, _ in spans)))
        return pd.DataFrame(rows, columns=["text", "n_replaced", "spans"])
    rows = docs.select("doc_id", "text", *_row(docs)).join(exceptions, ["k1", "k2"], "left")
    return rows.select("doc_id", run("text", "late").alias("r")).select("doc_id", "r.*")
