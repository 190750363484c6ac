"""9. Secret scans: candidates by pattern, false positives removed by a random forest.

A scan reads whole texts for candidates: strings in the formats of known
credentials, values assigned to a name such as ``token`` or ``password``, key
blocks, and any run of 20 or more characters of the alphabets that keys are
written in. A random forest then tells secrets from look-alikes (digests, ids,
long words, paths) by length, character classes and transitions, entropy, how
much of it is dictionary words, the document's path, and the words beside it.

The forest (bootstrap samples, random features at each split, Gini) is trained
in NumPy on labelled findings, a bounded sample of ``SAMPLE`` of each label.
``bootstrap_findings`` labels findings of a corpus that has no labels: known
formats and values with digits assigned to a credential's name are secrets;
bare runs without digits, unquoted values without any, and findings beside
words such as ``sha256`` or ``example`` are not.

Cases: a null or empty text has no candidate; a null path has no path cue;
overlapping candidates count once, as the first, to the end of the last; repeated rows
have the same findings each; with no findings to learn from, or of one label
only, the share of that label is the score of all (1 without any).
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectable.llm.blocks import slices, stored, tidy

SAMPLE = 2000
#: Public formats of credentials.
FORMATS = {
    "aws_access_key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "github_token": r"\bgh[pousr]_[A-Za-z0-9]{36,}\b",
    "slack_token": r"\bxox[abprs]-[A-Za-z0-9-]{10,}",
    "google_api_key": r"\bAIza[0-9A-Za-z_-]{35}\b",
    "stripe_key": r"\b[sr]k_(?:live|test)_[0-9A-Za-z]{16,}\b",
    "json_web_token": r"\beyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+",
    "private_key": r"-----BEGIN [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----",
}
NAMES = r"(?:api[_-]?key|access[_-]?key|secret|token|passw(?:or)?d|pwd|passphrase|auth|credential)"
#: A key block reaches to its end line whatever lies between; without one, over the lines that look like a key's.
KEY_END = r"-----END [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----"
KEY_LINES = r"(?:(?:\\[rn]|[\s\"'+#*>|])*+(?:[A-Z][A-Za-z-]{2,30}: [^\n\\]*+|[A-Za-z0-9+/=]{16,}+))*+"
#: What follows a name, to the end of the value.
ASSIGNED = r"[\"']?\s*+(?:=|:|=>)\s*+[\"']?(?P<value>[^\s\"'<>,;]{8,}+)"
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
#: Words that speak for or against a secret beside them, and in paths.
FOR = ("token", "secret", "password", "passwd", "pwd", "key", "auth", "credential", "bearer", "login")
AGAINST = ("sha", "md5", "hash", "checksum", "digest", "commit", "uuid", "guid", "example", "sample", "dummy", "placeholder", "integrity", "etag")
PATHS_AGAINST = ("test", "example", "fixture", "mock", "sample", "doc")
#: Common words of the dictionary, in four languages.
DICTIONARY = (
    "the and for with that this from have are was not you all can out use who has had her his one our there their what about which when make like time just know take people into year your good some could them see other than then now look only come its over think also back after how work first well way even new want because any these give day most "
    "les des est une pour pas que qui dans sur avec elle nous vous ment tion der die das und nicht ein eine ist mit von auf sich auch für los las con por para como más pero este esta ción name file path user data test value string public static return class list index http https www com org html page image link text"
).split()


#: Strings without which a text has no known format and no assignment.
MARKS = tuple(x.encode() for x in ("akia", "asia", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "aiza", "k_live_", "k_test_", "eyj", "-----begin"))
NAMED = tuple(x.encode() for x in ("key", "secret", "token", "passw", "pwd", "passphrase", "auth", "credential"))
_RUN_BYTES = bytes(b if chr(b).isalnum() and b < 128 or b in b"+/_-" else 32 for b in range(256))


class Scanner:
    """Finds candidates; what a text cannot have is not searched for."""

    def __init__(self):
        self.formats = re.compile("|".join(f"(?P<{k}>{p})" for k, p in FORMATS.items() if k != "json_web_token"))
        self.web_token, self.web_start, self.web_part = re.compile(FORMATS["json_web_token"]), re.compile(r"\beyJ"), re.compile(r"[A-Za-z0-9_-]*+")
        self.name, self.name_rest = re.compile(rf"(?i:{NAMES})"), re.compile(r"[\w-]*+")
        self.assigned, self.run = re.compile(ASSIGNED), re.compile(RUN)
        self.key_end, self.key_lines = re.compile(KEY_END), re.compile(KEY_LINES)

    def keys(self, text: str, found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
        """``found`` with the key blocks among it to their ends."""
        begins = [(start, end) for start, _, end, kind in found if kind == "private_key"]
        if not begins:
            return found
        stops = [m.end() for m in self.key_end.finditer(text, begins[0][1])]
        ends, k = {}, 0
        for (start, end), (later, _) in zip(begins, [*begins[1:], (len(text) + 1, 0)], strict=True):
            while k < len(stops) and stops[k] <= end:
                k += 1
            ends[start] = stops[k] if k < len(stops) and stops[k] <= later else self.key_lines.match(text, end).end()
        return [(start, rank, ends.get(start, end) if kind == "private_key" else end, kind) for start, rank, end, kind in found]

    def web_tokens(self, text: str) -> Iterator[re.Match]:
        """Tokens of three parts; where one begins and fails, no other one begins in its first part."""
        past = 0
        for m in self.web_start.finditer(text):
            if m.start() >= past:
                found = self.web_token.match(text, m.start())
                past = (found or self.web_part.match(text, m.start())).end()
                if found:
                    yield found

    def assignments(self, text: str) -> Iterator[re.Match]:
        """Values assigned to telling names; of several in one identifier the first decides."""
        past = 0
        for m in self.name.finditer(text):
            if m.start() >= past:
                past = self.name_rest.match(text, m.end()).end()
                found = self.assigned.match(text, past)
                if found:
                    past = found.end()
                    yield found

    def __call__(self, raw: bytes) -> tuple[str, list[tuple[str, int, int]]]:
        """The text (decoded if it has candidates) and (kind, start, end) of each
        candidate in code points, left to right; overlapping ones are the first of
        them, known formats before assignments before bare runs, to the last end."""
        low = raw.lower()
        marked, named = any(m in low for m in MARKS), any(m in low for m in NAMED)
        long = max(map(len, raw.translate(_RUN_BYTES).split()), default=0) >= 20
        if not (marked or named or long):
            return "", []
        text, found = raw.decode(), []
        if marked:
            found += self.keys(text, [(m.start(), 0, m.end(), m.lastgroup) for m in self.formats.finditer(text)])
            found += [(m.start(), 0, m.end(), "json_web_token") for m in self.web_tokens(text)]
        if named:
            found += [(m.start("value"), 1, m.end("value"), "assigned") for m in self.assignments(text)]
        if long:
            found += [(m.start(), 2, m.end(), "run") for m in self.run.finditer(text)]
        out, last = [], 0
        for start, _, end, kind in sorted(found):
            if start >= last:
                out.append((kind, start, end))
                last = end
            elif end > last:
                out[-1] = (*out[-1][:2], end)
                last = end
        return text, out


_WORDS = sorted({w for w in DICTIONARY if len(w) >= 3}, key=len, reverse=True)
_COVER = re.compile("|".join(map(re.escape, _WORDS)))
_NEAR = re.compile(r"\w+")
FEATURES = (
    "length", "digits", "upper", "lower", "marks", "transitions", "entropy", "hex", "longest_letters", "dictionary", "vowels",
    "known", "assigned", "quoted", "near_for", "near_against", "path_against",
)


def features(text: str, kind: str, start: int, end: int, path: str | None) -> list[float]:
    x = text[start:end]
    n = len(x)
    classes = "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "m" for c in x)
    counts = Counter(x)
    before, after = text[max(0, start - 60) : start].lower(), text[end : end + 40].lower()
    near = [*_NEAR.findall(before)[-4:], *_NEAR.findall(after)[:2]]
    low = x.lower()
    return [
        float(n),
        *(classes.count(c) / n for c in "dulm"),
        sum(a != b for a, b in zip(classes, classes[1:], strict=False)) / max(1, n - 1),
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        sum(c in "0123456789abcdefABCDEF" for c in x) / n,
        max(map(len, re.split(r"[^ul]+", classes))) / n,
        sum(len(m) for m in _COVER.findall(low)) / n,
        sum(c in "aeiou" for c in low) / max(1, classes.count("l") + classes.count("u")),
        float(kind in FORMATS),
        float(kind == "assigned"),
        float(before[-1:] in "\"'`" and before != ""),
        float(any(f in w for w in near for f in FOR)),
        float(any(w.startswith(f) for w in near for f in AGAINST)),
        float(any(f in (path or "").lower() for f in PATHS_AGAINST)),
    ]


def known_label(kind: str, f: list[float]) -> int | None:
    """A label where the finding itself tells; none otherwise."""
    get = dict(zip(FEATURES, f, strict=True)).get
    if kind in FORMATS:
        return 1
    if get("near_against"):
        return 0
    if kind == "assigned" and get("digits") > 0 and get("entropy") >= 2.5:
        return 1
    if kind == "assigned" and not get("quoted") and get("digits") == 0:
        return 0
    if kind == "run" and not get("near_for") and (get("digits") == 0 or get("dictionary") >= 0.4):
        return 0
    return None


class Forest:
    """A random forest as flat arrays: feature, threshold, children, share of secrets."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 25, depth: int = 8, seed: int = 11):
        r = np.random.default_rng(seed)
        self.nodes: list[list] = []
        self.roots = []
        if len(set(y.tolist())) < 2:
            self.roots = [self._leaf(y)]
            return
        for _ in range(trees):
            at = r.integers(0, len(y), len(y))
            self.roots.append(self._grow(x[at], y[at], depth, r))

    def _leaf(self, y: np.ndarray) -> int:
        self.nodes.append([-1, 0.0, -1, -1, float(y.mean()) if len(y) else 1.0])
        return len(self.nodes) - 1

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, r: np.random.Generator) -> int:
        if depth == 0 or len(y) < 4 or y.min() == y.max():
            return self._leaf(y)
        best = (1e9, -1, 0.0)
        for f in r.choice(x.shape[1], max(1, int(math.sqrt(x.shape[1]))), replace=False):
            values = np.unique(x[:, f])
            if len(values) < 2:
                continue
            for t in np.unique(np.quantile(values, np.linspace(0.04, 0.96, 16), method="lower")):
                left = x[:, f] <= t
                k = left.sum()
                if 0 < k < len(y):
                    p, q = y[left].mean(), y[~left].mean()
                    gini = (k * p * (1 - p) + (len(y) - k) * q * (1 - q)) / len(y)
                    best = min(best, (gini, int(f), float(t)))
        if best[1] < 0:
            return self._leaf(y)
        node = self._leaf(y)
        left = x[:, best[1]] <= best[2]
        self.nodes[node][:4] = best[1], best[2], self._grow(x[left], y[left], depth - 1, r), self._grow(x[~left], y[~left], depth - 1, r)
        return node

    def __call__(self, f: list[float]) -> float:
        total = 0.0
        for at in self.roots:
            while self.nodes[at][0] >= 0:
                k, t, low, high, _ = self.nodes[at]
                at = low if f[k] <= t else high
            total += self.nodes[at][4]
        return total / len(self.roots)


def _found(docs: DataFrame, keep: list[str], text_col: str, path_col: str, make, schema: str) -> DataFrame:
    """``make()(raw text, path)`` of each row gives tuples that follow its ``keep`` columns."""
    ins = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)]
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), F.col(path_col).cast("string").alias("path"), *ins)
    heads = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(keep))
    names = [x.split()[0] for x in schema.split(", ")]

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch in slices(batches):
            at, out = [], []
            for i, (text, path) in enumerate(zip(batch.column(0), batch.column(1).to_pylist(), strict=True)):
                found = call(text.as_py(), path)
                at += [i] * len(found)
                out += found
            index = pa.array(at, pa.int64())
            cols = [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(c.take(index) for c in batch.columns[2:]), *cols], names=[*batch.schema.names[2:], *names])

    arrow = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "array<double>": pa.list_(pa.float64())}
    kinds = [arrow[x.split()[1]] for x in schema.split(", ")]
    out = rows.mapInArrow(tidy(fn), f"{heads}, {schema}" if heads else schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], *names)


def bootstrap_findings(docs: DataFrame, text_col: str = "text", path_col: str = "source", sample: int = SAMPLE) -> DataFrame:
    """``features, label``: findings whose label is known, at most ``sample`` of
    each; a finding that is repeated with the same features is one."""

    def make():
        candidates = Scanner()

        def call(raw, path):
            out = []
            text, found = candidates(raw)
            for kind, a, b in found:
                f = features(text, kind, a, b, path)
                label = known_label(kind, f)
                if label is not None:
                    out.append((f, label, zlib.crc32(text[a:b].encode())))
            return out

        return call

    known = stored(_found(docs, [], text_col, path_col, make, "features array<double>, label int, digest long").distinct(), "findings")
    out = None
    for y in (0, 1):
        part = known.where(F.col("label") == y).orderBy("digest", F.xxhash64("features")).limit(sample)
        out = part if out is None else out.union(part)
    return out.select("features", "label")


def train_forest(findings: DataFrame, sample: int = SAMPLE) -> Forest:
    """From at most ``sample`` labelled findings of each label."""
    order = F.xxhash64("features")
    rows = [x for y in (0, 1) for x in findings.where(F.col("label") == y).orderBy(order).limit(sample).collect()]
    x = np.array([r["features"] for r in rows]).reshape(len(rows), len(FEATURES))
    return Forest(x, np.array([r["label"] for r in rows], dtype=np.float64))


def scan(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """A row for each candidate: ``id_col, start, length`` (code points), ``kind,
    digest`` (CRC-32 of the value, which is not shown), ``score`` (the forest's
    share of trees for a secret), ``secret`` (score of a half or more)."""

    def make():
        candidates = Scanner()

        def call(raw, path):
            out = []
            text, found = candidates(raw)
            for kind, a, b in found:
                s = forest(features(text, kind, a, b, path))
                out.append((a, b - a, kind, zlib.crc32(text[a:b].encode()), s, s >= 0.5))
            return out

        return call

    return _found(docs, [id_col], text_col, path_col, make, "start long, length long, kind string, digest long, score double, secret boolean")


def redact(docs: DataFrame, forest: Forest, text_col: str = "text", path_col: str = "source", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced by ``mask``; all rows
    and columns stay, null texts stay null."""

    def make():
        candidates = Scanner()

        def call(raw, path):
            out, at = [], 0
            text, found = candidates(raw)
            text = text or raw.decode()
            for kind, a, b in found:
                if forest(features(text, kind, a, b, path)) >= 0.5:
                    out += [text[at:a], mask]
                    at = b
            return [("".join([*out, text[at:]]),)]

        return call

    others = [c for c in docs.columns if c != text_col]
    none = "is_null_text_of_redact"
    rows = docs.withColumn(none, F.col(text_col).isNull())
    out = _found(rows, [*others, none], text_col, path_col, make, "redacted_text_of_redact string")
    text = F.when(~F.col(none), F.col("redacted_text_of_redact"))
    return out.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
