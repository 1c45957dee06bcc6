"""Personal data: base patterns, and spans that a character tagger adds.

Base spans (email, ip, card, phone) are leftmost matches per kind with their checks; they always stay.  A bidirectional LSTM with CRF
transitions (``tagger``) learns from windows labelled with base spans, ``TRAINING_WINDOWS`` at most, drawn by a hash from all windows of
all texts, and from copies of them in which a span is written as people write it where patterns don't look: national phone
numbers, "name (at) host (dot) org", "10[.]0[.]0[.]1", cards in other groups.

It tags all texts.  Windows of ``WINDOW`` characters start every ``STRIDE``, so each place is in two; spans of one kind that overlap
between windows become one, and of overlapping spans of several kinds the longest stays.  A tagged span is added if the score of
the window's tags loses ``MARGIN`` or more without it, if it overlaps no base span, begins and ends at a word's edge, and, read
plainly, passes the check of its kind (digits, parts, Luhn).

Every kind holds a digit, an @ or an "at" in brackets, so windows without any have no span that could be added and are not run.

Defined results: NULL and empty texts have no span; texts of any length are processed whole, in windows; repeated rows
get the same spans; an empty table gives an empty result.  Extra columns are ignored, or kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odmeter.llm.tagger import KINDS, PAD, Tagger, character_codes
from odmeter.session import ship_package

WINDOW, STRIDE = 96, 48
TRAINING_WINDOWS = 1500
UPDATES = 300
MARGIN = 10.0
RUN = 1024  # windows tagged at once

Span = tuple[str, int, int]

_AT = re.compile(r"[(\[{] ?(?:at|AT) ?[)\]}]")
_ANCHOR = re.compile(f"[0-9@]|{_AT.pattern}")
_BASE_ANCHOR = re.compile("[0-9@]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _small(parts: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts.split("."))


def _emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            out.append(("email", start, done))
        at = text.find("@", at + 1)
    return out


def base_spans(text: str | None) -> list[Span]:
    """Spans of the base patterns, by start, then kind."""
    if not text or not _BASE_ANCHOR.search(text):
        return []
    out = _emails(text)
    return in_order(out + [span for span, good in _candidates(text) if good])


def _candidates(text: str):
    """Matches of the patterns of digits, and whether they pass their checks."""
    for m in _IP.finditer(text):
        yield ("ip", *m.span()), _small(m.group())
    for kind, pattern, least, most in (("card", _CARD, 12, 19), ("phone", _PHONE, 9, 15)):
        for m in pattern.finditer(text):
            digits = "".join(_DIGITS.findall(m.group()))
            yield (kind, *m.span()), least <= len(digits) <= most and (kind == "phone" or luhn(digits))


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def windows(text: str, skip: bool = True) -> tuple[list[int], np.ndarray]:
    """Starts and character codes of the windows of a text; with ``skip`` only of those where an anchor begins."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    last = max(0, -(-(len(points) - WINDOW) // STRIDE))
    if skip:
        at = np.flatnonzero((points == 64) | ((points >= 48) & (points < 58)))
        at = np.append(at, np.array([m.start() for m in _AT.finditer(text)], np.int64)) // STRIDE
        at = np.unique(np.concatenate([at, at - 1]))
        numbers = np.unique(np.clip(at[at >= 0] if len(at) else at, 0, last)) if len(at) else at
    else:
        numbers = np.arange(last + 1)
    padded = np.concatenate([character_codes(points), np.full(WINDOW, PAD)])
    starts = [int(n) * STRIDE for n in numbers]
    return starts, np.stack([padded[s : s + WINDOW] for s in starts]) if starts else np.zeros((0, WINDOW), np.int64)


_WRITTEN_AT = re.compile(r" ?[(\[{] ?at ?[)\]}] ?", re.IGNORECASE)
_WRITTEN_DOT = re.compile(r" ?[(\[{] ?(?:dot|\.) ?[)\]}] ?", re.IGNORECASE)
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def plainly(text: str) -> str:
    """A span without the brackets around "at", "dot" and stops."""
    return _WRITTEN_DOT.sub(".", _WRITTEN_AT.sub("@", text))


def passes(kind: str, text: str) -> bool:
    """The check of a kind, however the text is grouped."""
    text = plainly(text)
    digits = "".join(_DIGITS.findall(text))
    if kind == "email":
        return bool(_EMAIL.fullmatch(text))
    if kind == "ip":
        return bool(_IP.fullmatch(text)) and _small(text)
    if kind == "card":
        return 12 <= len(digits) <= 19 and set(text) <= set("0123456789 .-/") and luhn(digits)
    return 9 <= len(digits) <= 15 and set(text) <= set("+0123456789 ().-/") and not text.isdigit()


def at_edges(text: str, start: int, end: int) -> bool:
    """Whether a span neither begins nor ends inside a word."""
    before, after = text[start - 1 : start], text[end : end + 1]
    return not (before.isalnum() and text[start].isalnum()) and not (after.isalnum() and text[end - 1].isalnum())


def reconcile(spans: list[Span]) -> list[Span]:
    """Spans of all windows of a text as one set without overlaps."""
    merged: list[Span] = []
    for kind in KINDS:
        for _, start, end in sorted(s for s in spans if s[0] == kind):
            if merged and merged[-1][0] == kind and start < merged[-1][2]:
                merged[-1] = (kind, merged[-1][1], max(end, merged[-1][2]))
            else:
                merged.append((kind, start, end))
    kept: list[Span] = []
    for span in sorted(merged, key=lambda s: (s[1] - s[2], s[1], KINDS.index(s[0]))):
        if all(span[2] <= k[1] or span[1] >= k[2] for k in kept):
            kept.append(span)
    return in_order(kept)


def all_spans(texts: list[str], tagger: Tagger, skip: bool = True) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    found: list[list[Span]] = [[] for _ in texts]
    owners, codes = [], []
    for k, text in enumerate(texts):
        if not text or (skip and not _ANCHOR.search(text)):
            continue
        starts, each = windows(text, skip)
        owners += [(k, s) for s in starts]
        codes.append(each)
    stacked = np.concatenate(codes) if codes else np.zeros((0, WINDOW), np.int64)
    for at in range(0, len(stacked), RUN):
        for row, kind, start, end, margin in tagger.spans(stacked[at : at + RUN]):
            k, first = owners[at + row]
            start, end = first + start, min(first + end, len(texts[k]))
            if start < end and margin >= MARGIN and _ANCHOR.search(texts[k], start, end):
                found[k].append((kind, start, end))
    out = []
    for text, own, tagged in zip(texts, base, found):
        ends = sorted((s, e) for _, s, e in own)
        added = [
            (kind, s, e) for kind, s, e in reconcile(tagged)
            if passes(kind, text[s:e]) and at_edges(text, s, e) and all(e <= a or s >= b for a, b in ends)
        ] if tagged else []
        out.append((own, in_order(own + added)))
    return out


def training_windows(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Codes and tags of the windows of a text with an anchor.

    Windows with a number that a pattern matches but its check turns down, and that is long enough for its kind, are left out: it may be a phone
    number before something else, or a card with a wrong digit, and neither is an example of a place outside.
    """
    tags = np.zeros(len(text) + WINDOW, np.int64)
    doubtful = np.zeros(len(text) + WINDOW, bool)
    for (kind, start, end), good in _candidates(text):
        if not good and kind != "ip" and end - start >= 12:
            doubtful[start:end] = True
    for kind, start, end in base_spans(text):
        k = KINDS.index(kind)
        tags[start] = 1 + 2 * k
        tags[start + 1 : end] = 2 + 2 * k
    starts, codes = windows(text)
    out = []
    for s, c in zip(starts, codes):
        if doubtful[s : s + WINDOW].any():
            continue
        own = tags[s : s + WINDOW].copy()
        for t in range(WINDOW):  # a span cut off by the window's start has no begin in it
            if own[t] and own[t] % 2 == 0 and (t == 0 or own[t - 1] not in (own[t], own[t] - 1)):
                own[t] -= 1
        out.append((c, own))
    return out


def otherwise(kind: str, text: str, draw: np.random.Generator) -> list[tuple[str | None, str]]:
    """A base span written in a way that the base patterns don't match as a whole: pieces with their kinds."""
    if kind == "email":
        at, dot = ((" (at) ", " (dot) "), ("(at)", "."), (" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", "."), (" [AT] ", " [DOT] "))[draw.integers(6)]
        local, _, host = text.partition("@")
        if draw.integers(2):  # names of letters alone
            local, host = _DIGITS.sub("", local).strip("._%+-") or "jo", _DIGITS.sub("", host)
        if draw.integers(2) and host.count(".") > 1:
            host = host.partition(".")[2]
        if draw.integers(2):
            host = host.rpartition(".")[0] + (".org", ".net", ".de", ".fr", ".co.uk", ".edu")[draw.integers(6)]
        return [(kind, local + at + host.replace(".", dot))]
    if kind == "ip":
        return [(kind, text.replace(".", ("[.]", "(.)", "[dot]")[draw.integers(3)]))]
    digits = "".join(_DIGITS.findall(text))
    if kind == "card":
        return [(kind, (".", "/", " - ")[draw.integers(3)].join(digits[k : k + 4] for k in range(0, len(digits), 4)))]
    form = draw.integers(9)
    if form > 5:  # right before an ip the pattern runs on and finds too many digits
        return [(kind, text), (None, " "), ("ip", ".".join(str(x) for x in draw.integers(10, 256, 4)))]
    area, rest = digits[-10:-7], digits[-7:]
    return [(kind, ("({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "({}) {} {}", "0{} {} {}", "{}/{}-{}")[form].format(area, rest[:3], rest[3:]))]


def rewritten(codes: np.ndarray, tags: np.ndarray, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """A window with one of its whole spans written otherwise; None if it has none."""
    begins = np.flatnonzero(tags % 2 == 1)
    if not len(begins):
        return None
    start = int(begins[draw.integers(len(begins))])
    kind = KINDS[(int(tags[start]) - 1) // 2]
    end = start + 1
    while end < len(tags) and tags[end] == tags[start] + 1:
        end += 1
    text = "".join(chr(int(c) - 3 + 32) for c in codes[start:end])
    if not start or tags[-1] or not passes(kind, text):
        return None  # a span is cut off by the window's edge
    new_codes, new_tags = [codes[:start]], [tags[:start]]
    for own, piece in otherwise(kind, text, draw):
        new_codes.append(character_codes(np.array([ord(c) for c in piece], np.uint32)))
        new_tags.append(np.zeros(len(piece), np.int64))
        if own:
            new_tags[-1][:] = 2 + 2 * KINDS.index(own)
            new_tags[-1][0] -= 1
    fill = np.full(len(codes), PAD)
    return np.concatenate([*new_codes, codes[end:], fill])[: len(codes)], np.concatenate([*new_tags, tags[end:], fill * 0])[: len(tags)]


def train(docs: DataFrame, rows: int = TRAINING_WINDOWS, updates: int = UPDATES) -> Tagger:
    """A tagger fitted on at most ``rows`` windows, drawn from all by a hash of their characters, and on a rewritten copy of each that has a whole span."""
    ship_package(docs.sparkSession)
    some = docs.where(F.col("text").rlike(_ANCHOR.pattern)).select("text")

    def label(batches):
        for batch in batches:
            out = []
            for text in batch.column(0):
                for codes, tags in training_windows(text.as_py()):
                    out.append((codes.astype(np.uint8).tobytes(), tags.astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.binary()) for c in (0, 1)], names=["codes", "tags"])

    made = some.mapInArrow(label, "codes binary, tags binary").distinct()
    made = made.orderBy(F.xxhash64("codes"), "codes", "tags").limit(rows).collect()
    tagger = Tagger()
    if made:
        codes, tags = (np.stack([np.frombuffer(r[c], np.uint8) for r in made]).astype(np.int64) for c in ("codes", "tags"))
        draw = np.random.default_rng(11)
        more = [x for x in (rewritten(c, t, draw) for c, t in zip(codes, tags)) if x]
        if more:
            codes, tags = (np.concatenate([was, np.stack([x[k] for x in more])]) for k, was in enumerate((codes, tags)))
        tagger.fit(codes, tags, updates)
    return tagger


def _spans_of(docs: DataFrame, tagger: Tagger, body, schema: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(tagger)

    def tag(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [t or "" for t in part.column(part.schema.get_field_index("text")).to_pylist()]
                yield body(part, texts, all_spans(texts, sent.value))

    return docs.mapInArrow(tag, schema)


def find(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """doc_id, counts and checksum of the base spans, and all spans, for every row of ``docs`` (doc_id bigint, text)."""
    ship_package(docs.sparkSession)
    tagger = tagger or train(docs)
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def body(part, texts, spans):
        counts = [[sum(s[0] == kind for s in base) for base, _ in spans] for kind in KINDS]
        hashes = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in spans]
        columns = [part.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array([written(x) for _, x in spans], pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _spans_of(rows, tagger, body, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans by that of the first."""
    out, done = [], 0
    for kind, start, end in spans:
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``docs`` with personal data masked; ``n_chars``, where there is one, is the new length."""
    ship_package(docs.sparkSession)
    tagger = tagger or train(docs)

    def body(part, texts, spans):
        place, old = part.schema.get_field_index("text"), part.column(part.schema.get_field_index("text"))
        new = [masked(t, s) if known else None for t, (_, s), known in zip(texts, spans, old.is_valid().to_pylist())]
        part = part.set_column(place, part.schema.field(place), pa.array(new, old.type))
        if "n_chars" in part.schema.names:
            at = part.schema.get_field_index("n_chars")
            lengths = [was if known is False else len(t or "") for was, t, known in zip(part.column(at).to_pylist(), new, old.is_valid().to_pylist())]
            part = part.set_column(at, part.schema.field(at), pa.array(lengths, part.column(at).type))
        return part

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return _spans_of(docs, tagger, body, fields)


def op2_personal_data(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find(docs.select("doc_id", "text"))
    n_spans = F.when(F.col("spans") == "", 0).otherwise(F.size(F.split("spans", ","))).cast("bigint")
    n_base = F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone")
    return found.withColumn("n_spans", n_spans).withColumn("n_added", F.col("n_spans") - n_base)
