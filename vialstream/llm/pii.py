"""Personal data: fixed patterns, and a linear-chain conditional random field over word-shape features.

The patterns find e-mail addresses, IPv4 addresses, payment cards and phone numbers that start with ``+``.
The field labels every word (O, or B/I of a kind) by its shape and that of its neighbours.  It is trained in numpy
on labelled rows that ``labelled_rows`` builds from forms and surroundings, and its weights are used as they were
learnt.  A labelled run becomes a span of its own if it overlaps no pattern's span and passes an exact check of its
kind (``checked``).

Texts are decoded whole and exactly by Viterbi, many at a time.  Words without digit or ``@`` have one and the same
feature, so a run of n such words is one step with the n-th max-plus power of their transition matrix; its inner
labels are walked out only where they may not all be O.  All patterns run in linear time, also on very long words.

Cases: a null text is empty and has no spans; equal or repeated rows get equal results; spans of one kind
never overlap; no rows give no rows; extra columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The patterns' spans, by kind, then start."""
    out: list[Span] = []
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            out.append((0, start, host.end()))
        past = host.end() if host else at + 1
        at = text.find("@", past)
    for m in _CHAIN.finditer(text):
        if m[0].count(".") >= 3:
            parts, p = m[0].split("."), m.start()
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                end = p + sum(map(len, four)) + 3
                if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                    out.append((1, p, end))
                p = end + 1
    for m in _CARD.finditer(text):
        if len(m[0]) <= 40 and 13 <= len(d := _only_digits(m[0])) <= 19 and luhn(d):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_only_digits(m[0])) <= 15:
            out.append((3, *m.span()))
    return out


# ---- the field ---------------------------------------------------------------------------

#: Forms of each kind: 9 is a random digit, a a random letter, é one beyond ASCII, L a digit that makes a Luhn number.
FORMS = {
    "email": ("aaaaa.aa@aaaa.aaa", "aaa99@aaaaa9.aaaa.aaa", "aé.aaaa@aaaaé.aa", "aaa_aaa@aaa.aa.aa", "<aaaa@aaaaa.aaa>", "é.aaa@aaa-aaa.aa", "(aaaa.a@aaa.aaa)", "aaaé+aaa@aaaa.aaa", "aaa'aaa@aaaa.aa"),
    "ip": ("9.9.9.9", "19.19.19.19", "192.168.9.19", "10.9.9.9:8080", "(172.16.9.19)", "[10.9.19.9]", "10.9.9.9/24"),
    "card": ("99999999 9999999L", "9999.9999.9999.999L", "9999/9999/9999/999L", "9999_9999_9999_999L", "9999 999999 9999L", "9999 9999 9999 999L", "9999-9999-9999-999L", "999999999999999L"),
    "phone": ("(999) 555-9999", "555-999-9999", "999.555.9999", "+9 (999) 555-9999", "999 555 9999", "0999 555 99 99", "(030) 9999-9999", "1-800-555-9999", "00 49 30 999 9999", "(999) 555 9999 ext 99", "555/999-9999"),
}
#: What is none of these.
OTHERS = (
    "19.99", "$1,999.50", "1999", "2021-03-04", "12:30", "9,999", "4.0.", "10.4.2", "v1.2.3-rc4", "99%", "3/4", "(3)", "42b", "@aaaa", "@", "a1", "9 of 999", "0.5 and 1.25",
    "10 20 30 40 50", "978-3-16", "1234567", "aaaa=9a9a9a9aaa99aa", "AKIA9AAAA9A9A", "99999999999999999999999", "2020 and 2021", "9.9.9", "9.9", "1.", "[9]", "9999-99", "99 99", "999 999",
)
#: Words around them.
BEFORE = ("the", "call", "write to", "at", "of", "under", "no", "with", "and", "from", "tel", "mail", "host", "card", "on", "in", "page", "about", "he said", "see")
AFTER = ("and of", "or write", "the", "today", "was", "he", "it was so", "to be", "und", "de la", ".", "for it", "that", "")


def luhn_end(digits: str) -> str:
    """The digit that makes a Luhn number of the digits."""
    return next(str(k) for k in range(10) if luhn(digits + str(k)))


def filled(form: str, rng: np.random.Generator) -> str:
    out, digits = [], ""
    for c in form:
        if c == "9":
            c = str(rng.integers(0, 10))
        elif c == "a":
            c = chr(97 + int(rng.integers(0, 26)))
        elif c == "é":
            c = "éüñößçøæ"[int(rng.integers(0, 8))]
        elif c == "L":
            c = luhn_end(digits)
        digits += c if c.isdigit() and c.isascii() else ""
        out.append(c)
    return "".join(out)


def labelled_rows(rows: int = 360, seed: int = 5) -> list[tuple[list[str], list[int]]]:
    """Labelled word sequences: each holds some forms, or others that look alike, among plain words."""
    rng = np.random.Generator(np.random.PCG64(seed))
    pick = lambda x: x[int(rng.integers(0, len(x)))]
    found = []
    for _ in range(rows):
        words, labels = [], []
        for _ in range(int(rng.integers(1, 4))):
            for w in pick(BEFORE).split():
                words.append(w)
                labels.append(0)
            kind = pick(KINDS) if rng.random() < 0.5 else None
            part = filled(pick(FORMS[kind]) if kind else pick(OTHERS), rng).split()
            if part and rng.random() < 0.25:
                part[-1] += pick((".", ",", ";"))
            for k, w in enumerate(part):
                words.append(w)
                labels.append(LABELS.index(("B-" if k == 0 else "I-") + kind) if kind else 0)
            for w in pick(AFTER).split():
                words.append(w)
                labels.append(0)
        found.append((words, labels))
    return found


def shape(word: str) -> str:
    """Letters as a, digits as 9; runs of letters count once, runs of other characters up to five."""
    out: list[str] = []
    run = 0
    for c in word:
        k = "9" if "0" <= c <= "9" else "a" if c.isalpha() else c
        run = run + 1 if out and out[-1] == k else 1
        if run <= (1 if k == "a" else 5):
            out.append(k)
    return "".join(out)


_EDGE = ".,;:!?\"'"


@functools.lru_cache(maxsize=50_000)
def word_features(word: str) -> tuple[str, ...]:
    if not any("0" <= c <= "9" or c == "@" for c in word):
        return ("plain",)
    core = word.strip(_EDGE)
    n = sum("0" <= c <= "9" for c in core)
    marks = "".join(sorted({c for c in core if not c.isalnum()}))
    looks = shape(core)
    kind = f"n={min(n, 20)}|m={marks}"
    return (f"s={looks}", f"n={min(n, 20)}", f"m={marks}", f"at={'@' in core}", f"dots={min(4, core.count('.'))}", f"alpha={any(c.isalpha() for c in core)}", f"first={looks[:1]}", kind, f"luhn={13 <= n <= 19 and luhn(_only_digits(core))}")


def features(words: list[str], k: int) -> list[str]:
    own = word_features(words[k])
    if own == ("plain",):
        return ["plain"]
    out = list(own)
    for d in (-1, 1):
        near = word_features(words[k + d]) if 0 <= k + d < len(words) else ("edge",)
        out += [f"{d}:{near[0]}", f"{d}:{near[1] if len(near) > 1 else near[0]}|{own[1]}", f"{d}:{near[0]}|{own[0]}"]
    return out


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)


class Field:
    """Weights of (feature, label) and (label, label)."""

    def __init__(self, rows: list[tuple[list[str], list[int]]], steps: int = 40, rate: float = 0.3, decay: float = 0.02) -> None:
        self.index: dict[str, int] = {}
        seqs = []
        for words, labels in rows:
            ids = [[self.index.setdefault(f, len(self.index)) for f in features(words, k)] for k in range(len(words))]
            seqs.append((ids, labels))
        n = len(LABELS)
        self.emit, self.move = np.zeros((len(self.index), n)), np.zeros((n, n))
        ge, gm = np.zeros_like(self.emit), np.zeros_like(self.move)  # squared gradients (Adagrad)
        for _ in range(steps):
            de, dm = decay * self.emit, decay * self.move
            for ids, labels in seqs:
                e = np.array([self.emit[i].sum(0) for i in ids])
                t = len(ids)
                f, b = np.zeros((t, n)), np.zeros((t, n))
                f[0] = e[0]
                for k in range(1, t):
                    f[k] = e[k] + _logsum(f[k - 1][:, None] + self.move, 0)
                for k in range(t - 2, -1, -1):
                    b[k] = _logsum(self.move + (e[k + 1] + b[k + 1])[None], 1)
                z = _logsum(f[-1], 0)
                p = np.exp(f + b - z)
                for k, i in enumerate(ids):
                    g = p[k].copy()
                    g[labels[k]] -= 1
                    de[i] += g
                for k in range(1, t):
                    dm += np.exp(f[k - 1][:, None] + self.move + (e[k] + b[k])[None] - z)
                    dm[labels[k - 1], labels[k]] -= 1
            ge += de**2
            gm += dm**2
            self.emit -= rate * de / np.sqrt(ge + 1e-8)
            self.move -= rate * dm / np.sqrt(gm + 1e-8)
        self._ready()

    def _ready(self) -> None:
        self.plain = self.emit[self.index["plain"]]
        self.one = self.move + self.plain[None]
        self.powers = [None, self.one]

    def power(self, n: int) -> np.ndarray:
        """The best score from each label over n plain words to each label."""
        if n <= 512:
            while len(self.powers) <= n:
                self.powers.append((self.powers[-1][:, :, None] + self.one[None]).max(1))
            return self.powers[n]
        half, rest = self.power(n // 2), self.power(n - n // 2)
        return (half[:, :, None] + rest[None]).max(1)

    def walk(self, first: int, last: int, n: int) -> list[int]:
        """The labels of n plain words between the label before them and that of the last of them."""
        out: list[int] = []
        while len(out) < n:
            left = n - len(out)
            if first == 0 and last == 0 and self.power(left)[0, 0] <= left * self.one[0, 0] + 1e-9:
                return out + [0] * left
            first = last if left == 1 else int((self.one[first] + self.power(left - 1)[:, last]).argmax())
            out.append(first)
        return out

    def emissions(self, rows: list[list[str]]) -> np.ndarray:
        """Scores of words from their lists of features."""
        ids = [[self.index[f] for f in fs if f in self.index] for fs in rows]
        out = np.zeros((len(rows), len(LABELS)))
        at = np.repeat(np.arange(len(rows)), [len(i) for i in ids])
        np.add.at(out, at, self.emit[[k for i in ids for k in i]])
        return out

    def decode(self, seqs: list[list[str]]) -> list[list[int]]:
        """Exact Viterbi labels of whole word sequences, side by side: a step for each marked word and the run before it."""
        marked = [[k for k, w in enumerate(s) if _MARK.search(w)] for s in seqs]
        runs = [np.diff([-1, *m, len(s)]) - 1 for m, s in zip(marked, seqs, strict=True)]
        n, steps = len(LABELS), max(map(len, marked), default=0)
        e = np.zeros((len(seqs), steps, n))
        if any(marked):
            flat = self.emissions([features(s, k) for s, m in zip(seqs, marked, strict=True) for k in m])
            lo = 0
            for r, m in enumerate(marked):
                e[r, : len(m)] = flat[lo : lo + len(m)]
                lo += len(m)
        size = np.array([len(m) for m in marked])
        best = np.zeros((len(seqs), n))
        over, into = (np.zeros((len(seqs), steps, n), np.int8) for _ in range(2))
        for k in range(steps):
            rows = np.flatnonzero(size > k)
            gap = np.array([runs[r][k] for r in rows])
            b = best[rows]
            if k == 0:
                for g in np.unique(gap[gap > 0]):
                    start = self.plain if g == 1 else (self.plain[:, None] + self.power(int(g) - 1)).max(0)
                    b[gap == g] = start
                b = np.where((gap > 0)[:, None], (step := b[:, :, None] + self.move[None]).max(1), 0.0)
                into[rows, 0] = step.argmax(1)
            else:
                for g in np.unique(gap[gap > 0]):
                    at = np.flatnonzero(gap == g)
                    step = b[at][:, :, None] + self.power(int(g))[None]
                    over[rows[at], k], b[at] = step.argmax(1), step.max(1)
                step = b[:, :, None] + self.move[None]
                into[rows, k], b = step.argmax(1), step.max(1)
            best[rows] = b + e[rows, k]
        return [self._labels(seqs[r], marked[r], runs[r].tolist(), best[r], over[r], into[r]) for r in range(len(seqs))]

    def _labels(self, words, marked, runs, best, over, into) -> list[int]:
        if not words:
            return []
        if not marked:
            first = int((self.plain if len(words) == 1 else (self.plain[:, None] + self.power(len(words) - 1)).max(1)).argmax())
            if len(words) == 1:
                return [first]
            return [first, *self.walk(first, int(self.power(len(words) - 1)[first].argmax()), len(words) - 1)]
        out: list[list[int]] = []
        tail = runs[-1]
        if tail:
            step = best[:, None] + self.power(tail)
            label, last = (int(x) for x in np.unravel_index(step.argmax(), step.shape))
            out.append(self.walk(label, last, tail))
        else:
            label = int(best.argmax())
        for k in range(len(marked) - 1, -1, -1):
            out.append([label])
            if k:
                last = int(into[k, label])
                label = int(over[k, last]) if runs[k] else last
                if runs[k]:
                    out.append(self.walk(label, last, runs[k]))
            elif runs[0]:
                last = int(into[0, label])
                ahead = self.plain if runs[0] == 1 else self.plain + self.power(runs[0] - 1)[:, last]
                first = last if runs[0] == 1 else int(ahead.argmax())
                out.append([first, *self.walk(first, last, runs[0] - 1)])
        return [x for part in reversed(out) for x in part]


@functools.lru_cache(maxsize=1)
def field() -> Field:
    return Field(labelled_rows())


_OPEN, _CLOSE = "\"',;:<([", ".,;:!?\"'>)]"
_HOST = re.compile(r"[^\s@]+@[^\s@.]+(?:\.[^\s@.]+)+")
_FOUR = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)(?:[:/][0-9]+)?")


def checked(kind: int, text: str, start: int, end: int) -> Span | None:
    """A labelled run without the marks around it, if it is what its kind must be: an address with a dotted host, four
    numbers to 255, a Luhn number of 13 to 19 digits, a number of 9 to 17 digits in two parts or more."""
    while end > start and text[end - 1] in _CLOSE:
        end -= 1
    while start < end and text[start] in _OPEN and not (kind == 3 and text[start] == "("):
        start += 1
    part = text[start:end]
    digits = _only_digits(part)
    if kind == 0:
        ok = _HOST.fullmatch(part) is not None
    elif kind == 1:
        four = _FOUR.fullmatch(part)
        ok = four is not None and all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four.groups())
    elif kind == 2:
        ok = 13 <= len(digits) <= 19 and luhn(digits)
    else:
        ok = 9 <= len(digits) <= 17 and len(part) > len(digits)
    return (kind, start, end) if ok else None


_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_MARK = re.compile(r"[0-9@]")


def all_spans(texts: list[str], base: list[list[Span]], crf: Field | None = None, batch: int = 256) -> list[list[Span]]:
    """Each text's pattern spans and those that the field adds, by kind, then start."""
    crf = crf or field()
    found = [list(b) for b in base]
    words = [[m.span() for m in _WORDS.finditer(t)] for t in texts]
    order = sorted(range(len(texts)), key=lambda t: len(words[t]))
    for lo in range(0, len(order), batch):
        part = order[lo : lo + batch]
        for t, labels in zip(part, crf.decode([[texts[t][a:b] for a, b in words[t]] for t in part]), strict=True):
            if not any(labels):
                continue
            k = 0
            while k < len(labels):
                if labels[k] == 0:
                    k += 1
                    continue
                kind, end = (labels[k] - 1) // 2, k + 1
                while end < len(labels) and labels[end] == 2 + 2 * kind:
                    end += 1
                got = checked(kind, texts[t], words[t][k][0], words[t][end - 1][1])
                if got and all(got[2] <= s or got[1] >= e for _, s, e in found[t]):
                    found[t].append(got)
                k = end
    return [sorted(f) for f in found]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _find(model):
    def run(batches):
        for rows, data, offs in slices(batches):
            yield _spans(rows, data, offs, model.value)

    return run


def _spans(rows: pa.RecordBatch, data: np.ndarray, offs: np.ndarray, crf: Field) -> pa.RecordBatch:
    mark = ((data >= 0x30) & (data <= 0x39)) | (data == 0x40)
    sums = np.concatenate([[0], np.cumsum(mark)])
    some = np.flatnonzero(sums[offs[1:]] > sums[offs[:-1]])  # the others hold nothing that a check accepts
    texts = [data[offs[k] : offs[k + 1]].tobytes().decode() for k in some]
    base = [base_spans(t) for t in texts]
    full = all_spans(texts, base, crf)
    n = rows.num_rows
    counts = np.zeros((4, n), np.int64)
    sha, spans = [hashlib.sha256(b"").hexdigest()] * n, [""] * n
    for k, b, s in zip(some, base, full, strict=True):
        for kind, _, _ in b:
            counts[kind, k] += 1
        sha[k] = hashlib.sha256(_joined(b).encode()).hexdigest()
        spans[k] = _joined(s)
    return pa.RecordBatch.from_arrays([rows.column(0), *map(pa.array, counts), pa.array(sha, pa.string()), pa.array(spans, pa.string())], [x.split()[0] for x in SCHEMA.split(", ")])


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts and a digest of the patterns' spans, and all spans in code points, a row for each document.

    The field is trained once, on the driver; its weights are about 30 kB.
    """
    model = docs.sparkSession.sparkContext.broadcast(field())
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_find(model), SCHEMA)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
