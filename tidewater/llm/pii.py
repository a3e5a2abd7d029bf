"""Personal data: four fixed patterns, and a CRF over word shapes for what
they miss (addresses spelled out, numbers without a plus sign).

The chain is fitted on ``labelled_table``, a small table of tagged tokens.
Every line of every text is a sequence of tokens decoded by Viterbi in numpy
batches.  A run of tokens with one tag is a span if it holds what its kind
needs and overlaps no span of the fixed patterns, which all stay.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import chunks
from .crf import fit, viterbi

KINDS = ("email", "ip", "card", "phone")
TAGS = ("other", *KINDS)
MEMO_TOKENS = 400_000

RESULT = T.StructType([T.StructField("doc_id", T.LongType()), *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
                       T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

# The contract's patterns (fixed values), arranged so that no text makes them
# try a run of characters again and again.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_NOT_DIGIT = re.compile("[^0-9]+")
_BREAK = re.compile(r"[.,;:!?]\s")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+|\n")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start, domain = at, _DOMAIN.match(text, at + 1)
        while domain and start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            end = domain.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the fixed patterns by kind, in code points."""
    out = {"email": _emails(text) if "@" in text else [], "ip": [], "card": [], "phone": []}
    if not _DIGIT.search(text):
        return out
    out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text) if 9 <= sum(map(str.isdigit, m.group())) <= 15]
    return out


# What a token can be, one feature each.
_FEATURES = ("bias", "lower", "capital", "upper", "mixed", "has digit", "all digits", "1-2 digits", "3 digits", "4 digits", "5-8 digits", "9-12 digits",
             "13-19 digits", "20+ digits", "at sign", "ends address", "at word", "dot word", "domain end", "plus", "brackets", "hyphen digits", "four parts",
             "address range", "checksum", "hex", "other mark", "long", "reach word", "card word", "net word", "call word")
_AT = {"at", "(at)", "[at]", "{at}", "<at>"}
_DOT = {"dot", "(dot)", "[dot]", "{dot}", "<dot>"}
_ENDS = {"com", "org", "net", "edu", "io", "de", "fr", "es", "uk", "info"}
_REACH, _CARDS = {"email", "e-mail", "mail", "write", "contact"}, {"card", "visa", "credit", "debit", "mastercard"}
_NETS, _CALLS = {"ip", "server", "host", "address", "ping"}, {"call", "phone", "tel", "telephone", "mobile", "fax", "ring", "dial"}


_MARKS = ".,;:!?\"'*#$%&"
_CUES = _AT | _DOT | _ENDS | _REACH | _CARDS | _NETS | _CALLS


def signature(token: str):
    """The same value for tokens that are sure to have the same shape: plain
    words apart from cue words count by their case and length alone."""
    core = token.strip(_MARKS)
    if core.isalpha() and core.lower() not in _CUES and token.lower() not in _CUES:
        return core.islower(), core.isupper(), core[:1].isupper() and core[1:].islower(), len(core) > 20
    return token


def shape(token: str) -> np.ndarray:
    """Feature vector of a token, from its shape and a few cue words."""
    core = token.strip(_MARKS)
    low = core.lower()
    digits = sum("0" <= c <= "9" for c in core)
    letters = sum(map(str.isalpha, core))
    parts = core.split(".")
    quad = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts)
    plain = _NOT_DIGIT.sub("", core) if digits >= 13 else ""
    on = {
        "bias": True, "lower": core.islower() and core.isalpha(), "capital": core[:1].isupper() and core[1:].islower(), "upper": core.isupper() and core.isalpha(),
        "mixed": letters > 0 and digits > 0, "has digit": digits > 0, "all digits": digits > 0 and digits == len(core), "1-2 digits": 1 <= digits <= 2, "3 digits": digits == 3,
        "4 digits": digits == 4, "5-8 digits": 5 <= digits <= 8, "9-12 digits": 9 <= digits <= 12, "13-19 digits": 13 <= digits <= 19, "20+ digits": digits >= 20,
        "at sign": "@" in core, "ends address": len(parts) > 1 and parts[-1].lower() in _ENDS, "at word": token.lower() in _AT, "dot word": token.lower() in _DOT,
        "domain end": low in _ENDS, "plus": core.startswith("+"), "brackets": "(" in core and digits > 0, "hyphen digits": "-" in core and digits >= 5 and not letters, "four parts": quad,
        "address range": quad and all(len(p) <= 3 and int(p) <= 255 for p in parts), "checksum": 13 <= digits <= 19 and len(plain) == digits and luhn(plain),
        "hex": letters > 0 and digits > 0 and len(core) >= 16, "other mark": not core.isalnum(), "long": len(core) > 20, "reach word": low in _REACH, "card word": low in _CARDS,
        "net word": low in _NETS, "call word": low in _CALLS}
    return np.array([on[f] for f in _FEATURES], np.float64)


def labelled_table(fills: int = 6, seed: int = 11) -> list[list[tuple[str, str]]]:
    """Tagged lines for fitting: patterns of (tag, text), where D is a random
    digit, C a card number with a right check digit, X one with a wrong one,
    N a number up to 255 and w a word."""
    patterns = [
        [("other", "please write to"), ("email", "w at w dot com"), ("other", "before w")], [("other", "w w"), ("email", "w [at] w [dot] org"), ("other", "w w .")],
        [("other", "contact"), ("email", "w (at) w (dot) net"), ("other", "or w")], [("email", "w dot w at w dot de"), ("other", "is w")],
        [("other", "mail"), ("email", "w.DD@w.example.com"), ("other", "w w w")], [("other", "w w"), ("email", "w@w.org"), ("other", "w")],
        [("other", "call"), ("phone", "(DDD) DDD-DDDD"), ("other", "w w")], [("other", "phone"), ("phone", "DDD-DDD-DDDD"), ("other", "w")],
        [("other", "w tel"), ("phone", "DDDD DDDDDDD"), ("other", "w w")], [("other", "w w"), ("phone", "+D (DDD) DDD-DDDD"), ("other", "w w")],
        [("other", "mobile"), ("phone", "+DD DDD DDDDDDD"), ("other", "w")], [("other", "w dial"), ("phone", "DDD DDD DDDD"), ("other", "w w")],
        [("other", "card"), ("card", "C"), ("other", "w w")], [("other", "w w"), ("card", "C"), ("other", "w")], [("other", "server"), ("ip", "N.N.N.N"), ("other", "w w")],
        [("other", "w w w"), ("ip", "N.N.N.N"), ("other", "w")], [("other", "w w X w w")], [("other", "order DDDDDDDD w DDDD w")], [("other", "w at w and w at w")],
        [("other", "the w at the w w")], [("other", "on D.D.DD w w")], [("other", "version D.D.D of w")], [("other", "w DDDD-DD-DD w DD:DD w")], [("other", "w DDD w DDDD w DD")],
        [("other", "looked at w dot w")], [("other", "W w w . W w w , w w .")], [("other", "W w at DD w")], [("other", "key AKIADDwDDwDDDDwDDDD w")], [("other", "w fafaDDDDfafaDDDDfafaDDDD w")],
        [("other", "totals DDD.DDD.DDD.DDD9 w")], [("other", "version D.D.DD.DDDDD w")], [("other", "w DDDDDDDDDDDDDDDDDDDDDDDD w")], [("other", "w | w | w # w $$$ w *** w")],
        [("other", "W w w w w w . W w w w w w w w .")], [("other", "sold at w dot")], [("other", "chapter D w D - D w")], [("other", "w w w w - w w w ( w w )")]]
    rnd = random.Random(seed)
    words = ["river", "stone", "lamp", "quiet", "orders", "green", "paper", "signal", "anna", "bruno", "market", "window", "ther", "ouen", "nder", "eraux"]

    def number(right: bool) -> str:
        body = "".join(rnd.choice("0123456789") for _ in range(15))
        check = next(d for d in "0123456789" if luhn(body + d))
        return body + (check if right else str((int(check) + rnd.randint(1, 9)) % 10))

    def fill(text: str) -> str:
        if text in ("C", "X"):
            return number(text == "C")
        return re.sub(r"(?<![A-Za-z])[wW](?![A-Za-z])|(?<=D)w(?=D)|D|N|X",
                      lambda m: {"w": rnd.choice(words), "W": rnd.choice(words).capitalize(), "D": rnd.choice("0123456789"), "N": str(rnd.randint(0, 255)), "X": number(False)}[m.group()], text)

    return [[(token, tag) for tag, text in line for token in fill(text).split()] for _ in range(fills) for line in patterns]


class Tagger:
    """The fitted chain, remembering tokens' scores within a task."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray):
        n = len(_FEATURES)
        self.parts, self.trans = (weights[:n], weights[n:2 * n], weights[2 * n:]), trans
        self.place: dict[str, int] = {}   # of a token's signature in scores
        self.known: dict = {}             # the same by signature
        self.scores = np.zeros((0, 3 * len(TAGS)))

    def tags(self, tokens: list[str], sizes: np.ndarray) -> np.ndarray:
        """Tag numbers of tokens lying in sequences of ``sizes``."""
        new = set(tokens) - self.place.keys()
        if len(self.place) + len(new) > MEMO_TOKENS:
            self.place, self.known, self.scores = {}, {}, self.scores[:0]
            new = set(tokens)
        first = []
        for token in new:
            key = signature(token)
            if key not in self.known:
                self.known[key] = len(self.known)
                first.append(token)
            self.place[token] = self.known[key]
        if first:
            shapes = np.array([shape(t) for t in first])
            self.scores = np.concatenate([self.scores, np.hstack([shapes @ w for w in self.parts])])
        k, at = len(TAGS), np.fromiter(map(self.place.__getitem__, tokens), np.int64, len(tokens))
        own = self.scores[at, :k]
        last = np.zeros(len(tokens), bool)
        last[np.cumsum(sizes)[sizes > 0] - 1] = True
        own[1:] += np.where(last[:-1, None], 0, self.scores[at[:-1], k:2 * k])  # the token before
        own[:-1] += np.where(last[:-1, None], 0, self.scores[at[1:], 2 * k:])   # the token after
        return viterbi(own, self.trans, sizes)


def train(lines: list[list[tuple[str, str]]] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions fitted on tagged lines, ``labelled_table`` by default."""
    lines = [x for x in (lines or labelled_table()) if x]
    own = np.array([shape(token) for x in lines for token, _ in x])
    sizes = np.array([len(x) for x in lines])
    first = np.zeros(len(own), bool)
    first[np.cumsum(sizes) - sizes] = True
    before = np.where(first[:, None], 0, np.roll(own, 1, axis=0))
    after = np.where(np.r_[first[1:], True][:, None], 0, np.roll(own, -1, axis=0))
    tags = np.array([TAGS.index(tag) for x in lines for _, tag in x])
    return fit(np.hstack([own, before, after]), tags, sizes, len(TAGS), steps=200)


def _holds(kind: str, text: str) -> bool:
    """What a span of a kind must have whatever the chain says."""
    digits = _NOT_DIGIT.sub("", text)
    if kind == "email":
        words = set(text.lower().split())
        return bool(words & _AT and words & _DOT) and not _BREAK.search(text) or "@" in text and "." in text
    if kind == "ip":
        return bool(_IP.fullmatch(text)) and all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and not any(map(str.isalpha, text))


def find_spans(texts: list[str], tagger: Tagger) -> list[tuple[dict, list[tuple[str, int, int]]]]:
    """For each text its base spans and all spans (kind, start, end), by kind and start."""
    base = [base_spans(t) for t in texts]
    tokens, sizes, where = [], [], []
    for i, text in enumerate(texts):
        line = 0
        for token in _TOKEN.findall(text):
            if token == "\n":
                sizes.append(line)
                where.append(i)
                line = 0
            else:
                tokens.append(token)
                line += 1
        sizes.append(line)
        where.append(i)
    more: dict[int, list] = {}
    if tokens:
        sizes = np.array(sizes)
        tags = tagger.tags(tokens, sizes)
        ends = np.cumsum(sizes)
        firsts = {}
        for k, i in enumerate(where):
            firsts.setdefault(i, int(ends[k] - sizes[k]))
        sequence = np.searchsorted(ends, np.flatnonzero(tags), side="right")
        for i in sorted({where[k] for k in sequence.tolist()}):
            more[i] = _added(texts[i], tags[firsts[i]:], base[i])
    return [(b, sorted([(k, *s) for k in KINDS for s in b[k]] + more.get(i, []), key=lambda s: (KINDS.index(s[0]), s[1])))
            for i, b in enumerate(base)]


def _added(text: str, tags: np.ndarray, base: dict) -> list[tuple[str, int, int]]:
    taken = [s for spans in base.values() for s in spans]
    runs, before, at = [], 0, 0
    for m in _TOKEN.finditer(text):
        if m.group() == "\n":
            before = 0
            continue
        tag = int(tags[at])
        at += 1
        if tag and tag == before:
            runs[-1][2] = m.end()
        elif tag:
            runs.append([KINDS[tag - 1], m.start(), m.end()])
        before = tag
    out = []
    for kind, start, end in runs:
        piece = text[start:end]
        start += len(piece) - len(piece.lstrip(".,;:!?\"'*#$%&|"))
        end = start + len(text[start:end].rstrip(".,;:!?\"'*#$%&|"))
        if _holds(kind, text[start:end]) and not any(a < end and start < b for a, b in taken):
            out.append((kind, start, end))
    return out


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def personal_data(docs: DataFrame, labelled: list[list[tuple[str, str]]] | None = None) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (of the
    fixed patterns), base_sha256 and spans (fixed and added ones).

    Null text counts as empty and has no spans.  Repeated rows are searched
    one by one; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(labelled))

    def run(batches):
        tagger = Tagger(*model.value)
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks(texts):
                found = find_spans(texts[a:b], tagger)
                digests = [hashlib.sha256(_joined((k, *s) for k in KINDS for s in base[k]).encode()).hexdigest() for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), *[pa.array([len(base[k]) for base, _ in found], pa.int64()) for k in KINDS],
                     pa.array(digests, pa.string()), pa.array([_joined(spans) for _, spans in found], pa.string())], RESULT.names)
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]).mapInArrow(run, RESULT)
