"""Personal data in whole texts: four plain patterns, and a character tagger.

The patterns give the base spans. The tagger (a bidirectional LSTM with a CRF) is trained
on spans labelled by the patterns in a bounded sample of documents, on such spans in
changed spellings, and on spans made up by rule, all set among the corpus's own prose. It
adds spans that touch no base span: other spellings of the same kinds.

Decoding goes over all windows of ``WINDOW`` characters, ``BLOCK`` of them shared with the next one,
of the whole text. Scores of neighbouring windows are blended, each weighted by the distance to its
window's edge, and one best path is sought over the whole text: no span breaks at a window's edge.
A stretch of tagged characters stays if its path is ``MARGIN`` better, as log odds, than leaving it out.

Null and empty texts have no spans; repeated rows get equal results; other columns are not
read. The sample holds ``SAMPLE`` ids, ``SAMPLE_CHARS`` characters from all over each; of rows with one
id the least text counts.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bilstm import PAD, Tagger, numbers
from .fmindex import with_texts
from .frames import cut, per_batch, table, texts

KINDS = ("email", "ip", "card", "phone")
BLOCK, BLOCKS = 32, 8
WINDOW, STRIDE = BLOCK * BLOCKS, BLOCK * (BLOCKS - 1)
#: Length of the training windows, size of the states: see the README for the recall by size.
TRAIN_WINDOW, HIDDEN = 64, 12
MARGIN = 3.0
SAMPLE, SAMPLE_CHARS, TRAIN_ROWS = 2000, 8000, 6000
#: Characters whose best paths are sought together, and windows that are scored together.
GROUP, PART = 1 << 19, 1024
#: Share of the training windows that hold nothing but prose.
PLAIN = 0.35
#: Tags: outside, then first and further characters of each kind.
TAGS = 1 + 2 * len(KINDS)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MARK = re.compile(r"[0-9@]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, sought from each at sign: the time stays linear on any text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _HOST.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of the plain patterns' spans, in order."""
    spans = [(0, a, b) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return spans
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            spans.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            spans.append((3, m.start(), m.end()))
    return spans


def _made_up(rng: np.random.Generator, kind: int, names: list[str]) -> str:
    """A span of a kind by rule, in a usual or a changed spelling."""
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    word = lambda: names[rng.integers(len(names))]
    if kind == 0:
        at = ("@", "@", "@", " @ ", " (at) ", "[@]")[rng.integers(6)]
        dot = "." if "(" not in at else " (dot) "
        tail = (digits(rng.integers(1, 4)), word(), "")[rng.integers(3)]
        return f"{word()}{('.', '_', '')[rng.integers(3)]}{tail}{at}{word()}{dot}{('com', 'org', 'net', 'de')[rng.integers(4)]}"
    if kind == 1:
        gap = (".", ".", ".", "[.]")[rng.integers(4)]
        return gap.join(str(rng.integers(0, 256)) for _ in range(4))
    if kind == 2:
        body = digits(15)
        body += next(d for d in "0123456789" if luhn(body + d))
        gap = ("", " ", "-", ".")[rng.integers(4)]
        return gap.join(body[i : i + 4] for i in range(0, 16, 4))
    shape = rng.integers(4)
    area, mid, end = digits(3), digits(3), digits(4)
    return (f"+{digits(1)} ({area}) {mid}-{end}", f"+{digits(2)} {area} {mid} {end}", f"({area}) {mid}-{end}", f"00{digits(2)} {area} {mid} {end}")[shape]


def _unrelated(rng: np.random.Generator, names: list[str]) -> str:
    """What is no personal data: words in brackets, counts, versions, dates, hex and keys."""
    if rng.random() < 0.15:
        word = names[rng.integers(len(names))]
        return (f"({word})", f"[{word}]", f"{word} ({word}) {word}.", f"{word}.{word}")[rng.integers(4)]
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    hexes = "".join("0123456789abcdef"[i] for i in rng.integers(0, 16, 32))
    upper = "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"[i] for i in rng.integers(0, 36, 20))
    return (digits(rng.integers(1, 6)), f"{digits(1)}.{digits(1)}", f"{digits(1)}.{digits(2)}.{digits(1)}", f"20{digits(2)}-0{digits(1)}-1{digits(1)}", hexes, upper, f"{digits(2)}:{digits(2)}", f"{digits(1)},{digits(3)}", digits(rng.integers(6, 12)))[rng.integers(9)]


def _varied(rng: np.random.Generator, prose: str) -> str:
    """The same prose with full stops, capitals and dots at some of its words; as long as before."""
    out = list(prose)
    for k in range(1, len(out) - 1):
        if out[k] == " " and rng.random() < 0.25:
            pick = rng.integers(3)
            if pick == 0 and out[k - 1].isalpha():
                out[k - 1] = ".,;:!?"[rng.integers(6)]
            elif pick == 1:
                out[k + 1] = out[k + 1].upper()[:1] or out[k + 1]
            elif out[k - 1].isalpha() and out[k + 1].isalpha():
                out[k] = "."
    return "".join(out)


def training_rows(sample: list[str], count: int, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the sample's prose with spans set in, and their tags."""
    rng = np.random.default_rng(seed)
    prose, real, names = [], [], set()
    for text in sample:
        spans = base_spans(text)
        real += [(k, text[a:b]) for k, a, b in spans if b - a < TRAIN_WINDOW]
        if not _MARK.search(text) and len(text) > 2 * TRAIN_WINDOW:
            prose.append(text)
        names.update(w.lower() for w in text.split()[:20] if w.isascii() and w.isalpha() and 2 < len(w) < 12)
    prose = prose or ["a plain line of words without any marks in it " * 4]
    names = sorted(names) or ["name", "mail", "host"]
    chars, tags = np.full((count, TRAIN_WINDOW), PAD, np.int64), np.zeros((count, TRAIN_WINDOW), np.int64)
    for row in range(count):
        source = prose[rng.integers(len(prose))]
        at = int(rng.integers(0, max(1, len(source) - 2 * TRAIN_WINDOW)))
        if rng.random() < PLAIN:
            chars[row] = numbers(_varied(rng, source[at : at + TRAIN_WINDOW]))
            continue
        parts, marks = [], []
        for _ in range(int(rng.integers(1, 4))):
            words = source[at : at + int(rng.integers(4, 30))]
            at += len(words)
            parts.append(words + " ")
            marks.append([0] * (len(words) + 1))
            pick = rng.random()
            if pick < 0.3:
                part, kind = _unrelated(rng, names), None
            elif pick < 0.6 and real:
                kind, part = real[rng.integers(len(real))]
                part = "".join(str(rng.integers(10)) if c.isdigit() and kind in (0, 3) else c for c in part)
            else:
                kind = int(rng.integers(len(KINDS)))
                part = _made_up(rng, kind, names)
            parts.append(part)
            marks.append([0] * len(part) if kind is None else [1 + 2 * kind] + [2 + 2 * kind] * (len(part) - 1))
            tail = (" ", ", ", ". ", "\n", "### ", "!! ")[rng.integers(6)]
            parts.append(tail)
            marks.append([0] * len(tail))
        text, mark = "".join(parts), sum(marks, [])
        shift = int(rng.integers(0, max(1, len(text) - TRAIN_WINDOW // 2)))
        code, mark = numbers(text)[shift : shift + TRAIN_WINDOW], np.array(mark[shift : shift + TRAIN_WINDOW], np.int64)
        # A span that the window cuts begins with a first tag all the same.
        if len(mark) and mark[0] and mark[0] % 2 == 0:
            mark[0] -= 1
        chars[row, : len(code)], tags[row, : len(mark)] = code, mark
    return chars, tags


def _allowed() -> np.ndarray:
    """Further characters follow a first or further one of their kind."""
    ok = np.ones((TAGS, TAGS), bool)
    for inside in range(2, TAGS, 2):
        ok[:, inside] = False
        ok[[inside - 1, inside], inside] = True
    return ok


def train(sample: list[str], steps: int = 220) -> Tagger:
    model = Tagger(TAGS, _allowed(), HIDDEN)
    model.fit(*training_rows(sample, TRAIN_ROWS), steps=steps)
    return model


def train_on(docs: DataFrame) -> Tagger:
    """Tagger trained on the documents with the smallest hashes of doc_id."""
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = (
        docs.filter("text IS NOT NULL")
        .select("doc_id", cut(F.col("text"), SAMPLE_CHARS).alias("text"))
        .join(F.broadcast(ids), "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    return train([r["text"] for r in rows])


#: Weight of the later one of two windows in the block they share.
_EDGE = (np.arange(1, BLOCK + 1) / (BLOCK + 1)).astype(np.float32)


def model_spans(found: list[str], model: Tagger) -> list[list[tuple[int, int, int]]]:
    """Kind, start and end of the tagger's spans in each text."""
    spans: list[list[tuple[int, int, int]]] = [[] for _ in found]
    same: dict[str, list[int]] = {}
    for row, text in enumerate(found):
        if text:
            same.setdefault(text, []).append(row)
    group, chars = [], 0
    for text in same:  # equal texts are read once
        group.append(text)
        chars += len(text)
        if chars >= GROUP:
            _tag(group, model, same, spans)
            group, chars = [], 0
    if group:
        _tag(group, model, same, spans)
    return spans


def _tag(group: list[str], model: Tagger, same: dict[str, list[int]], spans: list[list]) -> None:
    """Blend the scores of all windows of some texts, and add the spans of the best path to their rows."""
    sizes = np.array([len(t) for t in group])
    windows = np.maximum(0, -(-(sizes - WINDOW) // STRIDE)) + 1
    # Texts lie one after the other in blocks of characters, with an empty block behind each.
    blocks = windows * (BLOCKS - 1) + 2
    block = np.append(0, np.cumsum(blocks))
    codes = np.full(int(block[-1]) * BLOCK, PAD, np.uint8)
    for text, k in zip(group, block[:-1].tolist(), strict=True):
        codes[k * BLOCK : k * BLOCK + len(text)] = numbers(text)
    number = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    own = np.repeat(block[:-1], windows) + number * (BLOCKS - 1)
    blend = np.zeros((TAGS, int(block[-1]), BLOCK), np.float32)
    # Where two windows meet, their weights add up to 1; a text's first and last block have one window.
    begin, end = np.tile(_EDGE, (len(own), 1)), np.tile(_EDGE[::-1], (len(own), 1))
    begin[number == 0], end[number == np.repeat(windows, windows) - 1] = 1, 1
    for part in np.array_split(np.arange(len(own)), -(-len(own) // PART)):  # one text may be long
        at = own[part]
        scores = model.emissions(codes[at[:, None] * BLOCK + np.arange(WINDOW)])
        for k in range(1, BLOCKS - 1):  # no other window holds these blocks
            blend[:, at + k] = scores[:, :, k * BLOCK : (k + 1) * BLOCK]
        blend[:, at] += scores[:, :, :BLOCK] * begin[part]
        blend[:, at + BLOCKS - 1] += scores[:, :, -BLOCK:] * end[part]
    blend = blend.reshape(TAGS, -1)
    tags = model.best_path(blend, block[:-1] * BLOCK, sizes, MARGIN)
    # Stretches of other tags than 0 in one sweep; the block behind a text has tag 0.
    busy = np.concatenate([[0], (tags > 0).astype(np.int8), [0]])
    begins, ends = np.flatnonzero(np.diff(busy) == 1), np.flatnonzero(np.diff(busy) == -1)
    owner = np.searchsorted(block * BLOCK, begins, side="right") - 1
    trans = model.w["trans"]
    for a, b, g in zip(begins.tolist(), ends.tolist(), owner.tolist(), strict=True):
        low, path = int(block[g]) * BLOCK, tags[a:b]
        odds = float((blend[path, np.arange(a, b)] - blend[0, a:b]).sum() + (trans[path[:-1], path[1:]] - trans[0, 0]).sum())
        odds += float(trans[0, path[0]] - trans[0, 0]) if a > low else 0.0
        odds += float(trans[path[-1], 0] - trans[0, 0]) if b < low + sizes[g] else 0.0
        if odds < MARGIN:
            continue
        cuts = [a + k for k in np.flatnonzero(path % 2 == 1).tolist()] + [b]
        for x, y in zip(cuts, cuts[1:]):
            _add(group[g], int(tags[x] // 2), x - low, y - low, same, spans)


def _add(text: str, kind: int, start: int, end: int, same: dict[str, list[int]], spans: list[list]) -> None:
    while end > start and text[end - 1].isspace():
        end -= 1
    while start < end and text[start].isspace():
        start += 1
    if start < end:
        for row in same[text]:
            spans[row].append((kind, start, end))


def _union(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The stretches that spans cover, in order and apart from each other."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_spans(found: list[str], model: Tagger) -> list[tuple[list, list]]:
    """Base spans, and all spans, of each text: (kind, start, end) by kind, then start."""
    out = []
    for text, more in zip(found, model_spans(found, model), strict=True):
        base = base_spans(text)
        spans = list(base)
        taken = _union(base)
        starts = [x for x, _ in taken]
        for kind, a, b in more:
            k = bisect.bisect_left(starts, b) - 1  # the last taken stretch that begins before b
            if k < 0 or taken[k][1] <= a:
                spans.append((kind, a, b))
        out.append((base, sorted(spans)))
    return out


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, model: Tagger) -> DataFrame:
    """doc_id, base and all spans of every text, as kind:start:end lists."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = find_spans(texts(batch["text"]), model)
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array([_line(b) for b, _ in found]), pa.array([_line(s) for _, s in found])],
            ["doc_id", "base", "spans"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", "text"), step, f"doc_id {kind}, base string, spans string")


def mask(docs: DataFrame, model: Tagger) -> DataFrame:
    """The table with every span replaced by its kind in angle brackets; overlapping spans become one."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = texts(batch["text"])
        changed = {}
        for row, (_, spans) in enumerate(find_spans(found, model)):
            if not spans:
                continue
            parts, at = [], 0
            for a, k, b in sorted((a, k, b) for k, a, b in spans):
                if a >= at:
                    parts += [found[row][at:a], f"<{KINDS[k].upper()}>"]
                at = max(at, b)
            changed[row] = "".join([*parts, found[row][at:]])
        return with_texts(batch, changed)

    return per_batch(docs, step, docs.schema)


def op1_pii(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = find(docs, train_on(docs))
    count = lambda kind: F.regexp_count("base", F.lit(kind + ":")).cast("long").alias(f"n_{kind}")
    return out.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans"
    )
