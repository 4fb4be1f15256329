"""Brute-force versions of the operators' contracts, and awkward tables."""

import collections
import hashlib
import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ka lo mi ren tu vas ped or in sha qu el gor nim".split()


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(2, 4))) for _ in range(n)]


def thue_morse(n):
    """A word of a and b whose polynomial hash modulo a power of two is that of its complement, and that."""
    t = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return t, t.translate(str.maketrans("ab", "ba"))


def corpus(seed=5):
    """Copies, near copies, shared passages, nulls, blanks, ties and a very long text."""
    rng = random.Random(seed)
    base, shared = words(rng, 120), words(rng, 60)
    texts = [None, "", " \n\t ", "one", "One  two three four", "one two three four", "ünïcode wörds " * 30]
    texts += [" ".join(base)] * 6
    for i in range(30):
        near = list(base)
        for _ in range(rng.randint(1, 12)):
            near[rng.randrange(len(near))] = rng.choice(SYLLABLES)
        texts.append(" ".join(near))
    for i in range(12):
        texts.append(" ".join(words(rng, rng.randint(5, 80)) + shared + words(rng, rng.randint(5, 80))))
    texts += [" ".join(words(rng, rng.randint(1, 200))) for _ in range(25)]
    texts += ["same " * 400, " ".join(words(rng, 30_000)), "\n".join(["a line of text here"] * 12), "nbsp a b　c end  double  space"]
    one, other = thue_morse(2048)
    lead = words(rng, 20)
    texts += [" ".join([*lead, x, *lead[::-1]]) for x in (one, other)] + [one, other]
    texts += [" ".join([x, *(f"u{j}" for j in range(4))]) for x in (one, other)]
    return [(i, t, "en", None if i % 9 == 4 else f"src{i % 5}", len(t or "")) for i, t in enumerate(texts)]


def awkward(spark, rows):
    """The rows with columns that have the operators' own names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("score", "rank", "text_key", "size", "u", "row", "shard", "chunk", "words", "predicted", "n", "label"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def components(rows):
    sets = {}
    for i, t, *_ in rows:
        w = SPACED.findall((t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def phrases(rows, width=35):
    count, own = collections.Counter(), {}
    for i, t, *_ in rows:
        own[i] = w = SPACED.findall(t or "")
        count.update(tuple(w[j : j + width]) for j in range(len(w) - width + 1))
    out = {}
    for i, w in own.items():
        cov = [False] * len(w)
        for j in range(len(w) - width + 1):
            if count[tuple(w[j : j + width])] > 1:
                cov[j : j + width] = [True] * width
        kept = " ".join(x for x, c in zip(w, cov) if not c)
        out[i] = (len(w), sum(cov), hashlib.sha256(kept.encode()).hexdigest())
    return out


def contamination(rows, items):
    win, widths = collections.defaultdict(set), set()
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        k = min(10, len(w))
        if k:
            widths.add(k)
            for j in range(len(w) - k + 1):
                win[tuple(w[j : j + k])].add(i)
    out = {}
    for i, t, *_ in rows:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, names = [0] * len(w), set()
        for k in widths:
            for j in range(len(w) - k + 1):
                if own := win.get(tuple(w[j : j + k])):
                    names |= {str(x) for x in own if x is not None}
                    hit[j : j + k] = [1] * k
        out[i] = (len(w), sum(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), sum(hit) > 0)
    return out


def rules(t):
    w = SPACED.findall(t or "")
    c = collections.Counter(tuple(w[j : j + 8]) for j in range(len(w) - 7))
    cov = [0] * len(w)
    for j in range(len(w) - 7):
        if c[tuple(w[j : j + 8])] > 1:
            cov[j : j + 8] = [1] * 8
    lines = [x for x in (t or "").split("\n") if SPACED.search(x)]
    failed = len(w) < 20 or 100 * sum(cov) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), sum(cov), failed


def license_base(t):
    w = ALNUM.findall((t or "").translate(LOWER))
    hits = []
    for phrase, label in (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")):
        p = phrase.split()
        hits += [(j, label) for j in range(len(w) - len(p) + 1) if w[j : j + len(p)] == p]
    starts = [j for j, _ in hits]
    return len(w), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits}))


def _subsequence(a, b):
    """The length of the longest common subsequence, by the table of all prefixes."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            row[j + 1], before = max(row[j + 1], row[j], before + 1 if x == y else 0), row[j + 1]
    return row[-1]


def license_blocks(t, templates, threshold, slack):
    """All blocks that reach the threshold; of those that overlap the best, the first of equals."""
    import math

    w, out = ALNUM.findall((t or "").translate(LOWER)), []
    for label, name, text in templates:
        words = ALNUM.findall(text.translate(LOWER))
        tokens, size, best, until = set(words), math.ceil(slack * len(words)), None, -1
        need = math.ceil(threshold * len(tokens) - 1e-9)

        def put(s):
            last = max(j for j in range(s, min(s + size, len(w))) if w[j] in tokens)
            inside = [x for x in w[s : last + 1] if x in tokens]
            out.append((label, name, s, last + 1, round(len(set(inside)) / len(tokens), 9), _subsequence(words, inside) >= threshold * len(words) - 1e-9))

        for s, x in enumerate(w):
            if x not in tokens or len(tokens & set(w[s : s + size])) < need:
                continue
            got = len(tokens & set(w[s : s + size]))
            if best and s >= until:
                put(best[1])
                best = None
            if best is None or got > best[0]:
                best = (got, s)
                until = max(j for j in range(s, min(s + size, len(w))) if w[j] in tokens) + 1
        if best:
            put(best[1])
    return sorted(out, key=lambda x: (x[2], x[3], x[1]))


KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def personal(t):
    out = []
    for k in KINDS:
        for m in PATTERNS[k].finditer(t or ""):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
            if k == "email" or (k == "ip" and all(int(x) <= 255 for x in m.group().split("."))) or (k == "card" and 12 <= len(d) <= 19 and luhn) or (k == "phone" and 9 <= len(d) <= 15):
                out.append((k, m.start(), m.end()))
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return [sum(k == x for x, _, _ in out) for k in KINDS], ",".join(f"{k}:{a}:{b}" for k, a, b in out)
