"""PII replacement by keyed, type-consistent surrogates.

Detected kinds: e-mail addresses, IPv4 and IPv6 addresses, phone numbers (with
'+' or '(', or in the digit groups of a national form), payment card numbers
(also grouped 4-6-5 and 4-6-4), IBANs, US social security numbers, secret
tokens in assignments, and personal names: after a title, or a given name of
``given_names`` before a capitalised surname, up to five words with initials,
particles, apostrophes and hyphens. Not detected: names without title whose
given name is not listed, names all in capitals, phone numbers of seven digits
or less, and ungrouped or 3-3-3 grouped ones without '+', '(' or leading 0 (they
look like other numbers). Each entity has a canonical form (case, spaces and separators
removed), so different spellings of one entity are one entity.

A surrogate is a function of (key, kind, canonical form, attempt): digits and
letters come from an HMAC stream; length, punctuation, case and script stay;
valid card and IBAN checksums stay valid; private and public IP ranges stay
apart; mail domains keep their last label; names keep title, gender and script.
It is written in the format of the replaced spelling.

Collision check: one distinct table of all entities of the corpus. Entities
whose surrogate equals another entity's surrogate or any real entity take the
next attempt (the smallest canonical form keeps its place) until none is
left. Equal entities thus get equal surrogates everywhere (coreference) and
different entities different ones. Attempts above 0 are a small table joined
back to the documents concerned; all others need no join.

Defined cases: null text stays null, empty text empty; rows with a null doc_id
are treated like others; repeated rows get equal texts; very long texts are
scanned whole; other columns stay (``n_chars`` follows the new text).
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.given_names import GENDER, NOT_A_SURNAME
from strata.session import materialize

# Surrogate given names by gender and script, and surname syllables by script (fixed values).
GIVEN = {
    ("latin", "f"): "Anna Clara Elena Emma Ines Julia Laura Lena Lucia Maria Marta Nora Olivia Paula Sara Sofia".split(),
    ("latin", "m"): "Adam Anton Carlos David Emil Felix Hugo Jonas Karl Leon Lukas Martin Oscar Paul Simon Tomas".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Софья Юлия".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Денис Иван Михаил Олег Павел Роман Юрий".split(),
    ("greek", "f"): "Άννα Ελένη Ειρήνη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία".split(),
    ("greek", "m"): "Αντώνης Γιάννης Γιώργος Δημήτρης Κώστας Νίκος Πέτρος Στέλιος".split(),
}
SYLLABLES = {
    "latin": "ba be bo da do fa fe ga ge ha ka ke la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo za ze".split(),
    "cyrillic": "ба бе бо ва ве да до за ка ке ко ла ле ло ма ме мо на не но па пе ра ре ро са се со та те то".split(),
    "greek": "βα βε δα δε κα κο λα λε λο μα με μο να νε νο πα πε ρα ρε ρο σα σε σο τα τε το".split(),
}
SURNAME_END = {"latin": "n", "cyrillic": "н", "greek": "ς"}
# Titles and the gender they name (fixed values).
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Sir": "m", "Dr": "", "Prof": "", "Herr": "m",
          "Frau": "f", "Señor": "m", "Señora": "f", "Sr": "m", "Sra": "f", "Monsieur": "m", "Madame": "f",
          "Mme": "f", "Signor": "m", "Signora": "f", "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f"}

_GENDER = {n: g for (_, g), names in GIVEN.items() for n in names} | GENDER
_UPPER = r"[^\W\d_a-zà-öø-ÿа-яα-ωά-ώ]"
# A name part: Smith, O'Brien, d'Arc, Smith-Jones; more parts: F., van der Berg.
_CAP = rf"(?:[^\W\d_]{{1,2}}['’])?{_UPPER}[^\W\d_]+(?:['’-]{_UPPER}[^\W\d_]+)*"
_PARTICLE = r"(?:(?:de|del|della|di|da|dos|du|la|le|van|von|der|den|ter|ten|zu|bin|ibn|al|el|y) ){0,2}"
_MORE = rf"(?: (?:{_UPPER}\.|{_PARTICLE}{_CAP}))"
# Between the parts of a number: white space and the marks that noisy text puts after words.
_MARKS = r"[|!#$%&*]{0,4}"
_GAP = r"[\s|!#$%&*]{0,6}[-. ]?[\s|!#$%&*]{0,3}"
_NUMERIC = re.compile(
    r"(?P<email>[\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,})"
    r"|(?P<ipv6>(?<![\w.])(?:[0-9A-Fa-f]{0,4}:){2,7}(?:(?:\d{1,3}\.){3}\d{1,3}|[0-9A-Fa-f]{0,4})(?!\w|\.\d|:))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<secret>(?i:\b(?:token|secret|password|api[_ -]?key|access[_ -]?key)\b[\"']?\s*[=:]\s*[\"']?)"
    r"(?P<value>[A-Za-z0-9+/_-]{12,}))"
    r"|(?P<ip>(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d))"
    r"|(?P<card>(?<![\dA-Za-z])(?:(?:\d{4}[ -]?){3}\d{1,7}|\d{4}[ -]\d{6}[ -]\d{4,5})(?![\dA-Za-z]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<phone>(?<![\w.])(?:\+1" + _GAP + r"\(?|\()\d{3}\)?" + _GAP + r"\d{3}[-. ]" + _GAP + r"\d{4}(?!\d)"
    r"|(?<![\w.])\+\d{1,3}(?:[-. ]?\(?\d{2,5}\)?){2,4}(?![\d]|\.\d)"
    # national forms: 3-3-4, a leading 0 with pairs, with two or three groups, or ungrouped
    r"|(?<![\w.+/-])(?:(?:1[-. ])?(?:\d{3}[-.]\d{3}[-.]\d{4}|(?<!\d )[2-9]\d{2}" + _MARKS + r" \d{3}" + _MARKS
    + r"[-. ]\d{4})|(?<!\d )0[1-9](?:" + _MARKS + r"[-. ]\d{2}){4}(?! \d)"
    r"|(?<!\d )0\d{2,4}" + _MARKS + r"[-/ ](?:\d{3,4}" + _MARKS + r"[- ]\d{3,4}|\d{5,8})(?! \d)"
    r"|0[1-9]\d{8,9})(?!\w|[-./]\d))")
_TITLED = re.compile(
    r"\b(?P<title>" + "|".join(sorted(TITLES, key=len, reverse=True)) + r")\b\.? (?P<named>(?:" + _UPPER
    + r"\. ?){0,3}" + _CAP + _MORE + "{0,4})")
_WORDS = re.compile(r"\b" + _CAP + _MORE + "+")
_QUICK = re.compile(r"[0-9@]|(?i:token|secret|password|key)")


def _script(s: str) -> str:
    for c in s:
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
        if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
            return "greek"
    return "latin"


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def luhn_ok(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_ok(canon: str) -> bool:
    return int("".join(str(int(c, 36)) for c in canon[4:] + canon[:4])) % 97 == 1


def ipv6(s: str) -> str | None:
    """Canonical form of an IPv6 address, the dotted part of one that holds an
    IPv4 address; None for what only looks like one (times, hex dumps)."""
    try:
        a = ipaddress.IPv6Address(s)
    except ValueError:
        return None
    groups = [g for g in s.split(":") if g]
    if "." in s:
        return groups[-1]
    if "::" in s:
        plain = len(groups) > 1 and max(map(len, groups)) > 2 and any(c.isdigit() for c in s)
    else:
        plain = any(len(g) != 2 for g in groups)
    return a.compressed if plain else None


def _given(word: str) -> str:
    """Gender of a listed given name (also the first half of Jean-Luc), or ''."""
    return _GENDER.get(word) or _GENDER.get(word.split("-")[0], "")


def _name_parts(words: list[str], first: int) -> list[str]:
    """Leading words that can be one name: up to a word that continues no name;
    the last one is a surname, not an initial or particle."""
    n = first
    while n < len(words) and words[n] not in NOT_A_SURNAME:
        n += 1
    while n > first and (words[n - 1].endswith(".") or words[n - 1].islower()):
        n -= 1
    return words[:n]


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the entities, left to right."""
    out = []
    if _QUICK.search(text):
        for m in _NUMERIC.finditer(text):
            kind = m.lastgroup if m.lastgroup != "value" else "secret"
            if kind == "secret":
                s, e = m.span("value")
                out.append((s, e, kind, m["value"]))
                continue
            s, e = m.span()
            got = m.group()
            if kind == "email":
                canon = got.lower()
            elif kind == "iban":
                canon = got.replace(" ", "")
                if not iban_ok(canon):
                    continue
            elif kind == "ip":
                canon = got
            elif kind == "ipv6":
                s += got.startswith(":") and not got.startswith("::")
                e -= got.endswith(":") and not got.endswith("::")
                canon = ipv6(text[s:e])
                if canon is None:
                    continue
                if "." in canon:                             # an IPv4 address in IPv6
                    s, kind = e - len(canon), "ip"
            else:
                canon = _digits(got)
                if kind == "card" and not 13 <= len(canon) <= 19:
                    continue
                if kind == "phone" and not 7 <= len(canon) <= 15:
                    continue
            out.append((s, e, kind, canon))
    titled, taken = {}, set()
    for m in _TITLED.finditer(text):
        named = " ".join(_name_parts(m["named"].split(" "), 1))
        gender = TITLES[m["title"]] or _GENDER.get(named.split(" ")[0], "")
        s = m.start("named")
        titled.setdefault(named, gender or "m")
        taken.add(s)
        out.append((s, s + len(named), "name", f"{gender or 'm'}:{named}"))
    for m in _WORDS.finditer(text):
        words, s, i = m.group().split(" "), m.start(), 0
        while i < len(words):
            gender = _given(words[i])
            parts = _name_parts(words[i:i + 6], 1) if gender else words[i:i + 1]
            if len(parts) > 1 and s not in taken:
                name = " ".join(parts)
                out.append((s, s + len(name), "name", f"{titled.get(name, gender)}:{name}"))
            s += len(" ".join(parts)) + 1
            i += len(parts)
    # other mentions of a full name, without its title
    for canon in sorted({x[3] for x in out if x[2] == "name" and " " in x[3]}):
        for m in re.finditer(rf"\b{re.escape(canon.split(':', 1)[1])}\b", text):
            out.append((*m.span(), "name", canon))
    out.sort()
    clean, last = [], 0
    for x in out:
        if x[0] >= last:
            clean.append(x)
            last = x[1]
    return clean


class Keyed:
    """Surrogates under one secret key."""

    def __init__(self, key: bytes):
        self.key = key

    def _stream(self, *parts):
        seed = hmac.new(self.key, "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest()
        n = 0
        while True:
            for b in hashlib.sha256(seed + n.to_bytes(4, "big")).digest():
                yield b
            n += 1

    @staticmethod
    def _pick(stream, n: int) -> int:
        v = 0
        for _ in range(4):
            v = v << 8 | next(stream)
        return v % n

    def _alike(self, s: str, stream, hexadecimal: bool = False) -> str:
        """Same length and kind of character at every place."""
        out = []
        for c in s:
            if c.isdigit():
                out.append(str(self._pick(stream, 10)))
            elif hexadecimal and c in "abcdefABCDEF":
                out.append(("abcdef" if c.islower() else "ABCDEF")[self._pick(stream, 6)])
            elif "a" <= c <= "z":
                out.append(chr(97 + self._pick(stream, 26)))
            elif "A" <= c <= "Z":
                out.append(chr(65 + self._pick(stream, 26)))
            elif c.isalpha():
                script = _script(c)
                pool = "".join(SYLLABLES[script]) if script != "latin" else "abcdefghijklmnopqrstuvwxyz"
                r = pool[self._pick(stream, len(pool))]
                out.append(r.upper() if c.isupper() else r)
            else:
                out.append(c)
        return "".join(out)

    def canonical(self, kind: str, canon: str, attempt: int = 0) -> str:
        """Canonical form of the surrogate."""
        s = self._stream(kind, canon, attempt)
        if kind == "email":
            local, domain = canon.rsplit("@", 1)
            labels = domain.split(".")
            d = self._stream("domain", domain, attempt)     # one domain, one surrogate
            host = [self._alike(x, d) for x in labels[:-1]]
            return self._alike(local, s) + "@" + ".".join([*host, labels[-1]])
        if kind == "ip":
            a = [int(x) for x in canon.split(".")]
            private = 1 if a[0] == 10 else 2 if a[0] in (172, 192) and (a[0], a[1]) in \
                {(192, 168), *((172, x) for x in range(16, 32))} else 0
            first = [str(x) for x in a[:private]]
            rest = [str(1 + self._pick(s, 254)) for _ in range(4 - private)]
            if not private:                                  # public stays public
                rest[0] = "10"
                while rest[0] in ("10", "127", "172", "192"):
                    rest[0] = str(1 + self._pick(s, 223))
            return ".".join(first + rest)
        if kind == "ipv6":
            a = ipaddress.IPv6Address(canon)
            groups = [int(x, 16) for x in a.exploded.split(":")]
            # zero groups stay while few attempts were needed: the pool grows with need
            new = [1 + self._pick(s, 0xFFFF) if g or attempt > 3 else 0 for g in groups]
            if groups[0] >= 0xFC00:                          # local and multicast ranges stay
                new[0] = groups[0]
            elif groups[0]:
                new[0] = 0x2000 | self._pick(s, 0x2000)
            return str(ipaddress.IPv6Address(":".join(f"{g:x}" for g in new)))
        if kind == "card":
            body = canon[0] + "".join(str(self._pick(s, 10)) for _ in canon[2:])
            ends = [body + str(d) for d in range(10)]
            return next(x for x in ends if luhn_ok(x)) if luhn_ok(canon) else \
                [x for x in ends if not luhn_ok(x)][self._pick(s, 9)]
        if kind == "iban":
            body = self._alike(canon[4:], s)
            check = 98 - int("".join(str(int(c, 36)) for c in body + canon[:2] + "00")) % 97
            return f"{canon[:2]}{check:02d}{body}"
        if kind == "phone":
            keep = 1 if canon.startswith("1") and len(canon) == 11 or canon.startswith("0") else 0
            return canon[:keep] + "".join(str(2 + self._pick(s, 8)) if i == 0 else str(self._pick(s, 10))
                                          for i in range(len(canon) - keep))
        if kind == "secret":
            return self._alike(canon, s, all(c in "0123456789abcdefABCDEF" for c in canon))
        if kind == "name":
            gender, name = canon.split(":", 1)
            script = _script(name)
            given = GIVEN[script, gender]
            syllables = SYLLABLES[script]
            # later attempts draw longer surnames: the pool grows with need
            sur = "".join(syllables[self._pick(s, len(syllables))] for _ in range(3 + attempt // 2))
            sur = sur.capitalize() + SURNAME_END[script]
            first = given[self._pick(s, len(given))]
            if " " in name:
                middle = "".join(f"{given[self._pick(s, len(given))]} " for _ in name.split(" ")[2:])
                return f"{gender}:{first} {middle}{sur}"
            return f"{gender}:{first if name in _GENDER and attempt < 3 else sur}"
        return self._alike(canon, s)                         # ssn

    @staticmethod
    def written(kind: str, surface: str, canon: str) -> str:
        """The surrogate in the format of the replaced spelling."""
        if kind in ("card", "phone", "ssn", "iban"):
            fill = iter(canon)
            return "".join(next(fill) if c.isalnum() else c for c in surface)
        if kind == "name":
            return canon.split(":", 1)[1]
        if kind in ("email", "ipv6") and surface.isupper():
            return canon.upper()
        return canon


def _occurrences(docs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "th": [], "kind": [], "canon": []}
            for i, th, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                for kind, canon in sorted({(k, c) for _, _, k, c in find(text or "")}):
                    for name, v in zip(out, (i, th, kind, canon)):
                        out[name].append(v)
            yield pa.record_batch([pa.array(out["doc_id"], pa.int64()), pa.array(out["th"], pa.int64()),
                                   pa.array(out["kind"], pa.string()), pa.array(out["canon"], pa.string())],
                                  names=list(out))
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text")) \
        .mapInArrow(run, "doc_id long, th long, kind string, canon string")


def resolve(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, canon, attempt, surrogate) of distinct entities (kind, canon):
    all surrogates distinct within their kind and none a real entity."""
    keyed = Keyed(key)

    def draw(rows: DataFrame) -> DataFrame:
        def run(batches):
            for batch in batches:
                k, c, a = (batch.column(i).to_pylist() for i in range(3))
                yield pa.record_batch({"kind": batch.column(0), "canon": batch.column(1),
                                       "attempt": batch.column(2),
                                       "surrogate": pa.array([keyed.canonical(*x) for x in zip(k, c, a)], pa.string())})
        return rows.mapInArrow(run, "kind string, canon string, attempt int, surrogate string")

    real = entities.select("kind", F.col("canon").alias("surrogate"), F.lit(True).alias("real"))
    todo = draw(entities.select("kind", "canon", F.lit(0).alias("attempt")))
    settled = None
    while True:
        todo = todo.withColumn("fresh", F.lit(True))
        every = todo if settled is None else todo.unionByName(settled.withColumn("fresh", F.lit(False)))
        # settled entities keep their surrogate; then the smallest canonical form
        first = every.groupBy("kind", "surrogate").agg(F.min(F.struct("fresh", "canon")).alias("first"))
        judged = materialize(
            every.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
            .select("kind", "canon", "attempt", "surrogate",
                    ((F.col("first.canon") == F.col("canon")) & F.col("real").isNull()).alias("ok")), "surrogates")
        settled = judged.filter("ok").drop("ok")
        clash = judged.filter("NOT ok")
        if not clash.limit(1).count():
            return settled
        todo = draw(clash.select("kind", "canon", (F.col("attempt") + 1).cast("int").alias("attempt")))


def replace_pii(docs: DataFrame, key: bytes, count_col: str | None = "n_entities") -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with surrogates in the
    texts, plus the number of entities as ``count_col`` (instead of a column
    of that name; None: no such column). Column n_chars, if any, is
    recomputed."""
    found = materialize(_occurrences(docs), "pii-occurrences")
    settled = resolve(found.select("kind", "canon").distinct(), key)
    bumps = settled.filter("attempt > 0").select("kind", "canon", "attempt")
    # few entities need a later attempt, but one of them may be in many
    # documents: their rows are spread by salt
    salts = 16
    salted = bumps.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    per_doc = materialize(
        found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "th"), F.lit(salts)).cast("int"))
        .join(salted, ["kind", "canon", "salt"])
        .groupBy("doc_id", "th").agg(F.collect_set(F.struct("kind", "canon", "attempt")).alias("bumps")), "pii-bumps")
    names = [c for c in docs.columns if c not in ("text", count_col)]
    rows = docs.withColumn("__th", F.xxhash64(F.col("text").cast("string")))
    p = per_doc.select(F.col("doc_id").alias("__id"), F.col("th").alias("__pth"), F.col("bumps").alias("__bumps"))
    joined = rows.join(p, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__th") == F.col("__pth")), "left")
    keyed = Keyed(key)

    def run(batches):
        for batch in batches:
            texts, counts = [], []
            for text, bumps in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text is None:
                    texts.append(None)
                    counts.append(0)
                    continue
                later = {(b["kind"], b["canon"]): b["attempt"] for b in bumps or ()}
                parts, last, n = [], 0, 0
                for s, e, kind, canon in find(text):
                    new = keyed.canonical(kind, canon, later.get((kind, canon), 0))
                    parts += [text[last:s], keyed.written(kind, text[s:e], new)]
                    last, n = e, n + 1
                parts.append(text[last:])
                texts.append("".join(parts))
                counts.append(n)
            yield pa.record_batch([pa.array(texts, pa.string()), pa.array(counts, pa.int64()),
                                   *[batch.column(2 + i) for i in range(len(names))]],
                                  names=["__text", "__n", *[f"__{i}" for i in range(len(names))]])

    kinds = "".join(f", __{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    out = joined.select(F.col("text").cast("string").alias("__text"), "__bumps", *[F.col(f"`{c}`") for c in names]) \
        .mapInArrow(run, "__text string, __n long" + kinds)
    at = {c: f"__{i}" for i, c in enumerate(names)}
    cols = []
    for c in docs.columns:
        if c == count_col:
            continue
        if c == "text":
            cols.append(F.col("__text").alias("text"))
        elif c == "n_chars":
            cols.append(F.length("__text").cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append(F.col(at[c]).alias(c))
    return out.select(*cols, *([F.col("__n").alias(count_col)] if count_col else []))
