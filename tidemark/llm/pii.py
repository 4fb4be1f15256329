"""Personal data: candidate gradient boosting.

High-recall generators propose overlapping spans.  Boosted trees, a set for each kind,
score a span by the features of its format and context; none of the features is a test of
the base rules.  They learn from injected spans: examples of each kind, and look-alikes
(hashes of commits, product codes, tables of numbers, slugs), written by rule and a fixed seed into
snippets of the corpus.  Each kind's threshold is calibrated on a part of them that the
trees don't see.  Spans above it are redacted with those of the base rules, which always stay.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import boosting
from tidemark.llm.runtime import lowest, ship, table

KINDS = ("email", "ip", "card", "phone", "iban", "secret")
BASE = KINDS[:4]
#: Injected spans of each kind and label, and the snippets of the corpus they are written into, at most.
INJECTED = 600
SNIPPETS, SNIPPET_CHARS = 2000, 60
PRECISION = 0.99
TREES = 30
SEED = 29

# The base patterns.  A match begins where a run of its first characters begins, which the look-behinds say
# once, so that a long run isn't tried from each of its characters.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Generators of further candidates; none limits a candidate's length from above.
_AT = re.compile(r"\s?[\[(]?\s?(?:@|\b(?:at|AT)\b)\s?[\])]?\s?")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\s?[\[(]\s?dot\s?[\])]\s?|\sdot\s|\s?\.\s?)[A-Za-z0-9-]+)+")
_DOT = re.compile(r"\bdot\b")
_LOCAL_CHARS = frozenset(string.ascii_letters + string.digits + "._%+-")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9.-])")
_IP6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_SPACED_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[ ./_-]{1,3}[0-9]{4}){3}(?![0-9])")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b")
_SECRET = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+")
_ASSIGNED = re.compile(r"(?i)\b(?:[a-z_-]*(?:password|passwd|pwd|secret|token|api[ _-]?key|access[ _-]?key))\b\s*(?:[:=]|is)\s*[\"']?([^\s\"',;]{6,}+)")
#: Words in front of a span that speak for a kind, and, last, for something else.
_CUES = tuple(
    re.compile(rf"(?i)\b(?:{words})\b")
    for words in (
        "e-?mail|mail|write|contact|courriel|correo",
        "ip|host|server|address|adresse|ping|ssh",
        "card|visa|credit|karte|carte|tarjeta|mastercard",
        "phone|tel|call|mobile|fax|telefon|ruf|cell",
        "iban|account|konto|bank|compte|cuenta",
        "[a-z_-]*(?:key|token|secret|password|passwd|pwd|bearer|authorization|credentials?)",
        "commit|sha|sha1|sha256|md5|checksum|hash|etag|isbn|order|invoice|uuid|guid|version|pages?|years?|file|url|slug|serial|score|time",
    )
)

def _emails(text: str):
    """Matches of the base pattern, looked for around each @ only."""
    done, at = 0, text.find("@")
    while at >= 0:
        lead = _LOCAL.search(text, max(done, at - 4096), at)
        begin = lead.start() if lead else None
        if lead and begin == max(done, at - 4096) and begin > done:  # a longer run than was looked at
            begin = at
            while begin > done and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-")):
                begin -= 1
        m = _EMAIL.match(text, begin) if lead else None
        if m:
            yield m.start(), m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


_HAS_DIGIT = re.compile("[0-9]")


def looked_at(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, accepted) of the base patterns' matches, leftmost and non-overlapping per kind."""
    out = []
    if "@" in text:
        out += [("email", a, b, True) for a, b in _emails(text)]
    if _HAS_DIGIT.search(text):
        out += [("ip", m.start(), m.end(), all(map(_small, m.group().split(".")))) for m in _IP.finditer(text)]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 7:
                d = _digits(m.group())
                out.append(("card", m.start(), m.end(), 12 <= len(d) <= 19 and luhn(d)))
        if "+" in text:
            out += [("phone", m.start(), m.end(), 9 <= len(_digits(m.group())) <= 15) for m in _PHONE.finditer(text)]
    return out


def _spelled_emails(text: str):
    for m in _AT.finditer(text):
        a = m.start()
        while a and text[a - 1] in _LOCAL_CHARS:
            a -= 1
        if a < m.start() and (d := _DOMAIN.match(text, m.end())) and ("@" in m.group() or _DOT.search(d.group())):
            yield a, d.end()


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Further candidates (kind, start, end); they may overlap each other and the base spans."""
    out = []
    if "@" in text or "dot" in text:
        out += [("email", a, b) for a, b in _spelled_emails(text)]
    if _HAS_DIGIT.search(text):
        out += [("phone", m.start(), m.end()) for m in _LOCAL_PHONE.finditer(text)]
        out += [("card", m.start(), m.end()) for m in _SPACED_CARD.finditer(text)]
        out += [("iban", m.start(), m.end()) for m in _IBAN.finditer(text)]
        if "::" in text or text.count(":") > 1:
            out += [("ip", m.start(), m.end()) for m in _IP6.finditer(text)]
        for m in _SECRET.finditer(text):
            s = m.group()
            if _HAS_DIGIT.search(s) and any(c.isalpha() for c in s):
                out.append(("secret", m.start(), m.end()))
    if "=" in text or ":" in text or " is " in text:
        for m in _ASSIGNED.finditer(text):
            end = m.start(1) + len(m.group(1).rstrip(".:!?)]}"))
            if end - m.start(1) >= 6:
                out.append(("secret", m.start(1), end))
    return sorted(set(out))


_TLDS = frozenset("com org net edu gov io info de fr es it uk eu us ch at nl be pl ru cn jp br".split())
_PART = re.compile(r"[0-9A-Za-z]+")


def _remainder_97(s: str) -> int:
    s = "".join(_PART.findall(s.upper()))
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 if 15 <= len(s) <= 34 else 0


def features(text: str, kind: str, a: int, b: int) -> list[float]:
    """Format and context of a span."""
    s = text[a:b]
    n = max(len(s), 1)
    count = Counter(s)
    of = lambda chars: sum(count[c] for c in chars)
    digits, lower, upper = of(string.digits), of(string.ascii_lowercase), of(string.ascii_uppercase)
    letters = lower + upper
    parts = [len(x) for x in _PART.findall(s)] or [0]
    share = np.array(list(count.values()) or [1]) / n
    kinds = "".join("9" if c.isdigit() else "a" if c.isalpha() else "-" for c in s[:4096])
    words = re.split(r"\W+", s)
    before, after = text[a - 1] if a else " ", text[b] if b < len(text) else " "
    lead = text[max(0, a - 40) : a]
    return [
        float(n), digits / n, upper / max(letters, 1), letters / n, of("aeiouAEIOU") / max(letters, 1), of("0123456789abcdefABCDEF") / n,
        float(count["@"]), float(count["."]), float(count["-"]), float(count[" "]), float(count["_"]), float(count[":"]), float(count["("] + count["["]),
        float(len(parts)), float(parts[0]), float(parts[-1]), float(max(parts)), float(min(parts)),
        sum(x != y for x, y in zip(kinds, kinds[1:])) / max(len(kinds), 1), float(-(share * np.log2(share)).sum()), len(count) / min(n, 40),
        float(_DOT.search(s) is not None), float(words[-1].lower() in _TLDS), float(kind == "iban" and _remainder_97(s) == 1),
        float(before.isalnum()), float(after.isalnum()), float(before in "\"'`"), float(re.search(r"[:=]\s*[\"'`]?\Z", lead) is not None), float(after in "\"'`"),
        *(float(c.search(lead) is not None) for c in _CUES),
    ]


def _digits_of(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(string.digits) for _ in range(n))


def _token(rng: random.Random, n: int, chars: str = string.ascii_letters + string.digits) -> str:
    return "".join(rng.choice(chars) for _ in range(n))


def _word(rng: random.Random) -> str:
    return "".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))


def _iban(rng: random.Random, valid: bool) -> str:
    body = _digits_of(rng, rng.choice((14, 16, 18, 20))) if rng.random() < 0.7 else _token(rng, 4, string.ascii_uppercase) + _digits_of(rng, 14)
    land = _token(rng, 2, string.ascii_uppercase)
    check = 98 - int("".join(str(int(c, 36)) for c in body + land + "00")) % 97
    if not valid:
        check = (check + rng.randint(1, 96)) % 97
    s = f"{land}{check:02d}{body}"
    return " ".join(s[i : i + 4] for i in range(0, len(s), 4)) if rng.random() < 0.5 else s


def injected(rng: random.Random, kind: str, real: bool) -> tuple[str, str, str]:
    """(text before, span, text after) of an example of a kind, or of what only looks like one."""
    pick, num = rng.choice, lambda n: _digits_of(rng, n)
    if kind == "email":
        name, site, tld = pick((_word(rng), f"{_word(rng)}.{_word(rng)}", f"{_word(rng)}{num(2)}")), _word(rng) + _word(rng), pick(("com", "org", "net", "de", "fr", "edu"))
        if real:
            at, dot = pick((("@", " dot "), (" at ", " dot "), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" @ ", "."), (" AT ", " dot ")))
            return pick(("", "mail: ", "write to ", "contact ", "")), f"{name}{at}{site}{dot}{tld}", pick(("", " ", "."))
        tail = pick((f"the dot {_word(rng)}", f"a dot {_word(rng)}", f"{_word(rng)} dot {_word(rng)}", f"every dot {_word(rng)}"))
        return pick(("", "we ", "they ")), f"{_word(rng)} {pick(('at', '@'))} {tail}", " "
    if kind == "ip":
        if real:
            groups = [f"{rng.randrange(1 << 16):x}" for _ in range(8)]
            return pick(("", "host ", "ip: ", "server ", "ping ")), pick((":".join(groups), f"{':'.join(groups[:3])}::{groups[4]}", f"fe80::{':'.join(groups[:4])}")), ""
        return pick(("", "time ", "score ", "at ")), pick((f"{num(2)}:{num(2)}:{num(2)}", f"{num(1)}:{num(1)}:{num(1)}", f"{num(2)}:{num(2)}:{num(2)}:{num(2)}", ":".join(f"{rng.randrange(256):02x}" for _ in range(6)))), ""
    if kind == "card":
        first = pick("3456") if real else pick("0123456789")
        sep = pick((".", " - ", "/", "_", "  ", " ", "-"))
        lead = pick(("card ", "visa: ", "credit card number ", "card no. ")) if real else pick(("", "order ", "isbn ", "years ", "invoice ", "pages "))
        return lead, sep.join([first + num(3), *(num(4) for _ in range(3))]), ""
    if kind == "phone":
        sep = pick((" ", "-", "."))
        if real:
            area = pick((f"({num(3)})", num(3), f"0{num(2)}", f"({num(4)})"))
            return pick(("call ", "phone: ", "tel. ", "fax ", "mobile ", "tel ", "" if area[0] == "(" else "phone ")), f"{area}{pick((' ', sep))}{num(pick((3, 4)))}{sep}{num(4)}", ""
        return pick(("", "years ", "order ", "pages ", "from ")), pick((f"{num(2)}.{num(3)}.{num(3)}", f"{num(3)} {num(3)} {num(3)}", f"19{num(2)}-20{num(2)}-20{num(2)}", f"{num(4)} {num(4)} {num(4)}", f"978-{num(4)}-{num(4)}")), ""
    if kind == "iban":
        return pick(("", "iban ", "IBAN: ", "account ")) if real else pick(("", "serial ", "order ", "code ")), _iban(rng, real), ""
    hexes = lambda n: _token(rng, n, "0123456789abcdef")
    if real:
        name = pick(("token", "api_key", "secret", "password", "API-Key", "access key", "auth_token", "client_secret", "passwd"))
        quote = pick(("", '"', "'"))
        value = pick((hexes(32), hexes(40), hexes(64), _token(rng, rng.randint(20, 64)), "ghp_" + _token(rng, 36), "sk-" + _token(rng, 40), "AKIA" + _token(rng, 16, string.ascii_uppercase + string.digits), _token(rng, rng.randint(8, 19)), _word(rng) + num(3) + pick("!#$%&*")))
        return f"{name}{pick((' = ', '=', ': ', ' : '))}{quote}", value, quote
    shape = rng.randrange(8)
    if shape == 0:
        return pick(("commit ", "sha1 ", "checksum ", "md5: ", "etag ", "hash ")), hexes(pick((32, 40, 64))), ""
    if shape == 1:
        return pick(("uuid ", "id ", "")), "-".join(hexes(k) for k in (8, 4, 4, 4, 12)), ""
    if shape == 2:
        return "", "_".join(_word(rng) for _ in range(rng.randint(4, 7))) + f"_v{num(1)}", ""
    if shape == 3:
        return pick(("", "url ", "/")), "-".join([_word(rng), num(2), *(_word(rng) for _ in range(rng.randint(4, 7)))]), ""
    if shape == 4:
        return pick(("", "file ")), f"IMG_20{num(6)}_{num(6)}_{_word(rng)}", ""
    if shape == 5:
        return "", pick("aeiox=-_*") * rng.randint(10, 40) + num(1) + pick("abc") * rng.randint(10, 40), ""
    if shape == 6:
        return f"the {pick(('password', 'token', 'secret', 'api key'))} {pick(('is', ':'))} ", _word(rng) + _word(rng) + "lo", ""
    return "", "".join(_word(rng).capitalize() for _ in range(8)) + num(2), ""


@dataclass
class Model:
    """Trees and threshold of each kind that has both."""

    trees: dict[str, boosting.Boosted]
    threshold: dict[str, float]


def _examples(snippets: list[str], kind: str, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng, x, y = random.Random(f"{seed}-{kind}"), [], []
    for i in range(2 * INJECTED):
        before, span, after = injected(rng, kind, bool(i % 2))
        left, right = (rng.choice(snippets) if snippets else " ".join(_word(rng) for _ in range(8)) for _ in range(2))
        text = f"{left} {before}{span}{after} {right}"
        a = len(left) + 1 + len(before)
        x.append(features(text, kind, a, a + len(span)))
        y.append(i % 2)
    return np.array(x), np.array(y, np.int64)


def fit(snippets: list[str]) -> Model:
    """For each kind, trees on three quarters of its examples, and the lowest threshold whose precision on the others is PRECISION."""
    model = Model({}, {})
    for kind in KINDS:
        x, y = _examples(snippets, kind, SEED)
        held = np.arange(len(y)) // 2 % 4 == 0
        trees = boosting.fit(x[~held], y[~held], TREES)
        p, truth = trees.scores(x[held]), y[held]
        order = np.argsort(-p, kind="stable")
        precision = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero((precision >= PRECISION) & np.append(np.diff(p[order]) < 0, True))
        if len(good):  # half way to the next lower score
            low = p[order][good[-1] : good[-1] + 2].mean()
            model.trees[kind], model.threshold[kind] = trees, max(0.5, float(low))
    return model


def _cut_snippets(most: int):
    def run(batches):
        for b in batches:
            out = []
            for t in b.column(0).to_pylist():
                rng = random.Random(hashlib.md5(t.encode()).hexdigest())
                for _ in range(most):
                    a = rng.randrange(max(1, len(t) - SNIPPET_CHARS))
                    out.append(t[a : a + SNIPPET_CHARS])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["snippet"])

    return run


def corpus_snippets(docs: DataFrame, each: int = 10) -> list[str]:
    """Up to SNIPPETS short passages of documents with low hashes, in a fixed order."""
    key = F.xxhash64("doc_id", F.length("text"), F.substring("text", 1, 64))
    some = lowest(docs.where(F.length("text") > 0), key, SNIPPETS // each, "doc_id", "text").select("text")
    return sorted(r[0] for r in some.mapInArrow(_cut_snippets(each), "snippet string").collect())


_SCHEMA = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_spans", pa.int64())])
_DDL = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long"


def _name(spans) -> str:
    order = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join([f"{k}:{a}:{b}" for k, a, b in order])


def _redact(shared):
    def run(batches):
        model = shared.value
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            rows, more = [], {k: [] for k in model.trees}
            for i in range(len(ids)):
                t = texts[i].as_py() or ""
                base = {(k, x, y) for k, x, y, ok in looked_at(t) if ok}
                rows.append((ids[i], base))
                for s in proposals(t):
                    if s[0] in more and not any(x <= s[1] and s[2] <= y for _, x, y in base):
                        more[s[0]].append((i, s, features(t, *s)))
            extra: dict[int, set] = {}
            for kind, found in more.items():
                p = model.trees[kind].scores(np.array([x for _, _, x in found])) if found else ()
                for (i, s, _), q in zip(found, p, strict=True):
                    if q >= model.threshold[kind]:
                        extra.setdefault(i, set()).add(s)
            out = []
            for i, (doc, base) in enumerate(rows):
                own, every = _name(base), base | extra.get(i, set())
                n = [sum(k == kind for k, _, _ in base) for kind in BASE]
                out.append((doc, *n, hashlib.sha256(own.encode()).hexdigest(), _name(every), len(every)))
            yield table(_SCHEMA, out)

    return run


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Spans of personal data in whole texts.

    Returns a row for each input row: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256 (of kind:start:end, code points with an exclusive end, by start and then
    kind, comma-joined), spans (with those the trees add, written likewise) and n_spans (how
    many those are).  Null and empty texts have no spans.  Rows with one id, and equal rows,
    get a row each.  Other columns are not looked at, whatever their names.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit(corpus_snippets(docs))
    return docs.mapInArrow(_redact(spark.sparkContext.broadcast(model)), _DDL)


def op8_personal_data(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    return find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"))
