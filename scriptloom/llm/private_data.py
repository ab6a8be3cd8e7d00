"""Personal data in texts: fixed patterns, and a linear-chain conditional random field beside them.

The patterns find e-mail addresses, IP addresses, card and phone numbers as they are defined; what
they find always stays. The field labels the words of a line by their shapes (kinds of characters,
lengths of digit runs, check digits, a few words around) and adds what the patterns miss: numbers
written without a plus, addresses spelled with "(at)". Its weights are fitted to a small labelled
table by the gradient of the likelihood, and lines are decoded by Viterbi, many at a time.

A word can only belong to personal data if a word with a digit or an at-sign stands at most ``REACH`` words
away. All others are held to "nothing", which cuts the chain into short pieces that are decoded exactly and
side by side; a piece may be as long as its line, time and memory stay linear in it.

Every pattern is applied in time linear in the text: runs of local parts, digits and signs are
entered once only, at their start.

Defined results: a null text is empty and has no spans; added spans that touch a fixed one are
dropped; repeated rows and null ids are rows like others; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,base:boolean>>"
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

# --- fixed patterns ---------------------------------------------------------------------------

LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part is the run before an at-sign, as far as no earlier match or sign took it."""
    free, at = 0, text.find("@")
    while at >= 0:
        before = text[free:at]
        start = at - (len(before) - len(before.rstrip(LOCAL)))
        found = DOMAIN.match(text, at + 1) if start < at else None
        free = at + 1
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", at + 1)


def small_parts(address: str) -> bool:
    parts = [part.lstrip("0") for part in address.split(".")]
    return all(len(part) <= 3 and int(part or 0) <= 255 for part in parts)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what the fixed patterns find, sorted."""
    if not text:
        return []
    found = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    found += [(m.start(), m.end(), "ip") for m in IP.finditer(text) if small_parts(m.group())]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = NO_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        found += [
            (m.start(), m.end(), "phone")
            for m in PHONE.finditer(text)
            if 9 <= len(NO_DIGIT.sub("", m.group())) <= 15
        ]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


# --- the small labelled table -----------------------------------------------------------------

# Lines with marks. The part in braces is drawn anew for each line; marks of a kind in KINDS are labels.
LINES = (
    "write to {email} for details", "contact: {email}", "{email}", "mail {email} or call {phone}",
    "please send it to {email} today.", "Kontakt: {email}, Telefon {phone}", "écrire à {email} avant lundi",
    "correo {email} y teléfono {phone}", "{word} {word}{email} {word}", "{word}, {email} {word} {word}.",
    "tel {phone}", "phone: {phone}", "call me at {phone} after six", "Tel.: {phone}", "{word} {phone} {word}",
    "fax {phone}, room {small}", "{word} {word} {phone}", "appelez le {phone}", "{Word} {phone}.",
    "llame al {phone} ahora", "mobile {phone} / office {phone}", "{phone}",
    "server {ip} is down", "from {ip} port {small}", "host {ip}", "{word} {ip} {word}", "ping {ip}, then {ip}",
    "Adresse {ip} antwortet", "{ip}", "login from {ip} at {time}", "ip: {ip}", "{word} {word} {ip}.",
    "card {card}", "pay with {card} please", "Visa {card} exp {time}", "{word} {card} {word}", "Karte {card}",
    "carte {card} valable", "tarjeta {card}", "{card}", "number {card}, code {small}",
    "{word} {long} {word}", "order {long} shipped", "{long}", "id {long} {word}", "ref {long}, page {small}",
    "{word} {small} {word}", "in {year} and {year}", "on {date} at {time}", "page {small} of {small}",
    "version {version} of the tool", "{version}", "section {version} says {small}", "price {price} each",
    "{price} {word}", "{date}", "{year}", "total {long}", "chapter {small}: {word}", "{word} {year}",
    "Licensed under CC BY {version}", "Version {version}", "{small} {small} {small}", "{word}{small} {word}",
    "{time} {word}", "see @{word} there", "{word}@{word}", "@{word}", "room {small} level {small}",
    "isbn {isbn}", "{isbn}", "{word} {isbn} {word}", "key {hex}", "{hex} {word}", "id={hex}", "{word}={long}",
    "{word} {date} {word}", "{small}% of {long}", "the {small}th {word}", "lines {small}-{small}",
    "{word} {small}.{small} {word}", "{long} {long}", "{word} {long}.", "code {code}", "{code} {code}",
    "sku {code} {word}", "from {year} to {year}, {small} {word}", "{hex}{hex}", "token {hex}{long}",
)
WORDS = ("the", "of", "ering", "und", "heit", "que", "ción", "les", "ment", "thand", "onre", "hast", "est", "para")
LABELLED_ROWS = 480


def _digits(rnd: random.Random, n: int) -> str:
    return "".join(rnd.choices("0123456789", k=n))


def _drawn(kind: str, rnd: random.Random) -> str:
    d, word = lambda n: _digits(rnd, n), lambda: rnd.choice(WORDS)
    if kind == "word":
        return word() + rnd.choice(("", "", ",", "."))
    if kind == "Word":
        return word().capitalize()
    if kind == "email":
        name, host = f"{word()}.{d(2)}", f"{word()}.{rnd.choice(('com', 'org', 'net', 'de'))}"
        host = rnd.choice((host, f"mail{d(1)}.{host}"))
        return rnd.choice((f"{name}@{host}",) * 3 + (f"{name} (at) {host}", f"{name} [at] {host}", f"{name}(at){host}"))
    if kind == "phone":
        area, end = d(3), d(4)
        return rnd.choice(
            (f"+1 ({area}) 555-{end}", f"+{d(2)} {d(3)} {d(6)}", f"({area}) 555-{end}", f"({area}) {d(3)}-{end}",
             f"{area}-{d(3)}-{end}", f"00{d(2)} {area} {d(7)}", f"+1 ({area}) 555-{end}", f"+{d(2)} {d(2)} {d(2)} {d(2)} {d(2)}")
        )
    if kind == "ip":
        v4 = ".".join(str(rnd.randint(1, 254)) for _ in range(4))
        v6 = "fe80::" + ":".join(f"{rnd.getrandbits(16):x}" for _ in range(4))
        return rnd.choice((v4, v4, v4, f"{v4}:{d(4)}", v6))
    if kind in ("card", "long"):
        while True:
            number = rnd.choice("123456789") + d(15 if kind == "card" else rnd.choice((11, 15, 15, 15, 17)))
            if luhn(number) == (kind == "card"):
                break
        apart = rnd.choice(("", "", " ", "-", ".", "/")) if kind == "card" else rnd.choice(("", "", "", "-"))
        return apart.join(re.findall(".{1,4}", number))
    if kind == "small":
        return d(rnd.choice((1, 2, 3, 4))).lstrip("0") or "7"
    if kind == "year":
        return rnd.choice(("19", "20")) + d(2)
    if kind == "date":
        return rnd.choice((f"20{d(2)}-{d(2)}-{d(2)}", f"{d(2)}.{d(2)}.20{d(2)}", f"{d(2)}/{d(2)}/19{d(2)}"))
    if kind == "time":
        return rnd.choice((f"{d(2)}:{d(2)}", f"{d(2)}:{d(2)}:{d(2)}", f"{d(2)}/{d(2)}"))
    if kind == "version":
        return rnd.choice((f"{d(1)}.{d(1)}", f"{d(1)}.{d(2)}.{d(1)}", f"v{d(1)}.{d(1)}"))
    if kind == "price":
        return rnd.choice((f"${d(3)}.{d(2)}", f"{d(2)},{d(2)} €", f"{d(1)},{d(3)}.{d(2)}"))
    if kind == "isbn":
        return f"978-{d(1)}-{d(4)}-{d(4)}-{d(1)}"
    if kind == "hex":
        return f"{rnd.getrandbits(64):x}"
    return f"{word()[:2].upper()}-{d(5)}"


def labelled_table(rows: int = LABELLED_ROWS, seed: int = 12) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """(text, spans) of ``rows`` lines; each form of LINES is used in turn."""
    rnd, made = random.Random(seed), []
    for number in range(rows):
        text, spans = "", []
        for part in re.split(r"(\{\w+\})", LINES[number % len(LINES)]):
            if part.startswith("{"):
                kind = part[1:-1]
                value = _drawn(kind, rnd)
                if kind in KINDS:
                    spans.append((len(text), len(text) + len(value), kind))
                text += value
            else:
                text += part
        made.append((text, spans))
    return made


# --- shapes -----------------------------------------------------------------------------------

REACH = 3
LONGEST = 40  # a longer word has a shape of its own kind, whatever its characters are
SIGNAL = re.compile(r"[0-9@]|[(\[]at[)\]]")
RUNS = re.compile(r"[0-9]+|[^\W\d_]+|[\W_]|\d")
WORD = re.compile(r"\S+")
EDGE = "edge"  # stands for what lies before and behind a line
LABELS = ("", *(f"{p}-{k}" for k in KINDS for p in "BI"))


def shape(word: str) -> tuple[str, ...]:
    """The features of a word, at most a handful of short strings."""
    if len(word) > LONGEST:
        return ("long-signal" if SIGNAL.search(word) else "long",)
    if not SIGNAL.search(word):
        plain = word.strip(".,:;!?").lower()
        kind = "upper" if word[:1].isupper() else "lower" if word[:1].islower() else "sign"
        return (f"word {plain}" if len(plain) <= 9 else "word", kind, f"last {word[-1:] if not word[-1:].isalnum() else ''}")
    runs = RUNS.findall(word)
    sketch = "".join(f"d{min(len(r), 20)}" if r[0].isdigit() else "x" if r[0].isalpha() else r for r in runs)
    core = sketch.strip(".,:;!?%#*$&|\"'<>")
    digits = NO_DIGIT.sub("", word)
    return (
        f"shape {core}", f"kinds {re.sub('d[0-9]+', 'd', core)}", f"digits {min(len(digits), 20)}",
        f"first {core[:1]}", f"letters {'x' in core}",
        f"check {12 <= len(digits) <= 19 and luhn(digits)}",
        f"parts {min(word.count('.'), 4)} {min(word.count(':'), 3)} {min(word.count('-'), 3)}",
        f"signal {'@' if '@' in word else 'at' if 'at' in word else ''}",
    )


# --- the field --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """``emit``: weights [offset, feature, label] with offsets -REACH+1 .. REACH-1; ``move``: [from, to]."""

    features: dict[str, int]
    emit: np.ndarray
    move: np.ndarray

    def of(self, features: Iterable[str]) -> np.ndarray:
        """The scores [offset, label] that a word with these features adds around itself."""
        at = [self.features[f] for f in features if f in self.features]
        return self.emit[:, at].sum(axis=1) if at else np.zeros(self.emit[:, 0].shape)


OFFSETS = 2 * REACH - 1


def allowed_moves() -> np.ndarray:
    """-inf where a label cannot follow: an inner label needs the same kind before it."""
    move = np.zeros((len(LABELS), len(LABELS)))
    for i, before in enumerate(LABELS):
        for j, after in enumerate(LABELS):
            if after.startswith("I") and before[2:] != after[2:]:
                move[i, j] = -np.inf
    return move


def labels_of(text: str, spans: list[tuple[int, int, str]]) -> list[int]:
    out = []
    for m in WORD.finditer(text):
        label = 0
        for start, end, kind in spans:
            if m.start() < end and m.end() > start:
                label = LABELS.index(f"{'B' if m.start() <= start else 'I'}-{kind}")
        out.append(label)
    return out


def train(table: list[tuple[str, list[tuple[int, int, str]]]] | None = None, rounds: int = 120,
          penalty: float = 0.02, rate: float = 0.25) -> Field:
    """Weights by gradient steps (Adam) on the penalised likelihood of the labelled lines."""
    table = labelled_table() if table is None else table
    lines = [([shape(m.group()) for m in WORD.finditer(text)], labels_of(text, spans)) for text, spans in table]
    lines = [x for x in lines if x[0]]
    known: dict[str, int] = {}
    for words, _ in lines:
        for features in (*words, (EDGE,)):
            for f in features:
                known.setdefault(f, len(known))
    n, length, kinds = len(lines), max(len(w) for w, _ in lines), len(LABELS)
    # (line, place, offset, feature) of every feature that acts on a place, edges included
    line, place, offset, feature = [], [], [], []
    gold = np.zeros((n, length), dtype=np.int64)
    real = np.zeros((n, length), dtype=bool)
    for i, (words, labels) in enumerate(lines):
        gold[i, : len(labels)], real[i, : len(labels)] = labels, True
        for t in range(len(words)):
            for o in range(OFFSETS):
                at = t + o - (REACH - 1)
                for f in words[at] if 0 <= at < len(words) else (EDGE,):
                    line.append(i)
                    place.append(t)
                    offset.append(o)
                    feature.append(known[f])
    cell = np.array(line) * length + np.array(place)
    weight_at = np.array(offset) * len(known) + np.array(feature)
    emit, move = np.zeros((OFFSETS * len(known), kinds)), np.zeros((kinds, kinds))
    closed = allowed_moves()
    lengths = real.sum(axis=1)
    target_emit, target_move = np.zeros_like(emit), np.zeros_like(move)
    np.add.at(target_emit, (weight_at, gold.ravel()[cell]), 1)
    padded = np.concatenate((np.zeros((n, 1), np.int64), gold), axis=1)
    np.add.at(target_move, (padded[:, :-1][real], padded[:, 1:][real]), 1)
    np.add.at(target_move, (padded[np.arange(n), lengths], 0), 1)  # the edge behind a line is "nothing"
    order = np.argsort(weight_at, kind="stable")
    starts = np.concatenate(([0], np.flatnonzero(np.diff(weight_at[order])) + 1))
    used = weight_at[order][starts]
    cell_starts = np.concatenate(([0], np.flatnonzero(np.diff(cell)) + 1))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (emit, move)]
    for round_ in range(1, rounds + 1):
        score = np.zeros((n * length, kinds))
        score[cell[cell_starts]] = np.add.reduceat(emit[weight_at], cell_starts, axis=0)
        marginal, pair = expectations(score.reshape(n, length, kinds), move + closed, real, lengths)
        expected = np.zeros_like(emit)
        expected[used] = np.add.reduceat(marginal.reshape(-1, kinds)[cell[order]], starts, axis=0)
        for x, gradient, (first, second) in (
            (emit, target_emit - expected - penalty * emit, moments[0]),
            (move, target_move - pair - penalty * move, moments[1]),
        ):
            first += 0.1 * (gradient - first)
            second += 0.01 * (gradient**2 - second)
            x += rate * (first / (1 - 0.9**round_)) / (np.sqrt(second / (1 - 0.99**round_)) + 1e-8)
    return Field(known, emit.reshape(OFFSETS, len(known), kinds), move + closed)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis=axis)) + most.squeeze(axis)


def expectations(score: np.ndarray, move: np.ndarray, real: np.ndarray, lengths: np.ndarray):
    """Marginals [line, place, label] and the expected number of moves [from, to], by forward-backward."""
    n, length, kinds = score.shape
    ahead, back = np.zeros((n, length, kinds)), np.zeros((n, length, kinds))
    ahead[:, 0] = move[0] + score[:, 0]
    for t in range(1, length):
        ahead[:, t] = log_sum(ahead[:, t - 1, :, None] + move[None], 1) + score[:, t]
    every = np.arange(n)
    back[every, lengths - 1] = move[:, 0]
    for t in range(length - 2, -1, -1):
        later = log_sum(move[None] + (score[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        back[:, t] = np.where((t < lengths - 1)[:, None], later, back[:, t])
    total = log_sum(ahead[every, lengths - 1] + move[:, 0], 1)
    marginal = np.exp(ahead + back - total[:, None, None]) * real[:, :, None]
    pair = np.zeros((kinds, kinds))
    for t in range(1, length):
        both = ahead[:, t - 1, :, None] + move[None] + (score[:, t] + back[:, t])[:, None, :] - total[:, None, None]
        pair += (np.exp(both) * real[:, t, None, None]).sum(axis=0)
    pair[0] += marginal[:, 0].sum(axis=0)
    pair[:, 0] += marginal[every, lengths - 1].sum(axis=0)
    return marginal, pair


def viterbi(score: np.ndarray, move: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The best labels of pieces that lie one behind the other in ``score`` [place, label]."""
    order = np.argsort(-lengths, kind="stable")
    start, size = starts[order], lengths[order]
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(longest), side="left")  # pieces longer than t
    best = np.zeros((len(start), score.shape[1]))
    came = np.zeros(score.shape, dtype=np.int8)
    for t in range(longest):
        at = start[: alive[t]] + t
        if t:
            paths = best[: alive[t], :, None] + move[None]
            came[at] = paths.argmax(axis=1)
            best[: alive[t]] = paths.max(axis=1) + score[at]
        else:
            best[: alive[t]] = move[0] + score[at]
    out = np.zeros(len(score), dtype=np.int8)
    now = (best + move[:, 0]).argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        at = start[: alive[t]] + t
        out[at] = now[: alive[t]]
        now[: alive[t]] = came[at, now[: alive[t]]]
    return out


class Decoder:
    """Labels of words; scores of words that were met before are kept up to ``held_bytes``."""

    def __init__(self, field: Field, held_bytes: int = 16 << 20):
        self.field, self.held_bytes = field, held_bytes
        self.clear()

    def clear(self) -> None:
        self.number = {}
        self.shapes = {(EDGE,): 0}
        self.scores = [self.field.of((EDGE,))]
        self.signal = [False]
        self.bytes = 0

    def place(self, word: str) -> int:
        features = shape(word)
        at = self.shapes.get(features)
        if at is None:
            at = self.shapes[features] = len(self.scores)
            self.scores.append(self.field.of(features))
            self.signal.append(SIGNAL.search(word) is not None)
            self.bytes += 1200
        if len(word) <= LONGEST:
            self.number[word] = at
            self.bytes += 150 + 4 * len(word)
        return at

    def spans(self, lines: list[str]) -> list[list[tuple[int, int, str]]]:
        """(start, end, kind) found in each line."""
        if self.bytes > self.held_bytes:
            self.clear()
        known, ids, begins = self.number, [0] * REACH, []
        for line in lines:
            words = line.split()
            begins.append(len(ids))
            found = list(map(known.get, words))
            if None in found:
                found = [self.place(w) if i is None else i for w, i in zip(words, found)]
            ids += found
            ids += [0] * REACH
        flat = np.array(ids)
        signal = np.flatnonzero(np.array(self.signal)[flat])
        active = np.zeros(len(flat), dtype=bool)
        for shift in range(-REACH, REACH + 1):
            active[np.clip(signal + shift, 0, len(flat) - 1)] = True
        active &= flat != 0
        at = np.flatnonzero(active)
        out: list[list[tuple[int, int, str]]] = [[] for _ in lines]
        if not len(at):
            return out
        table = np.array(self.scores)
        score = np.zeros((len(at), len(LABELS)))
        for o in range(OFFSETS):
            score += table[flat[at + o - (REACH - 1)], o]
        first = np.concatenate(([True], np.diff(at) > 1))
        starts = np.flatnonzero(first)
        label = np.zeros(len(flat), dtype=np.int8)
        label[at] = viterbi(score, self.field.move, starts, np.diff(np.append(starts, len(at))))
        hit = np.flatnonzero(label)
        line_of = np.searchsorted(begins, hit, side="right") - 1
        for number in np.unique(line_of).tolist():
            line, begin = lines[number], begins[number]
            for i, m in enumerate(WORD.finditer(line)):
                name = LABELS[label[begin + i]]
                if not name:
                    continue
                if name[0] == "I" and out[number]:
                    start, _, kind = out[number].pop()
                    out[number].append((start, m.end(), kind))
                else:
                    out[number].append((m.start(), m.end(), name[2:]))
        return [[trimmed(line, span) for span in spans] for line, spans in zip(lines, out)]


def trimmed(line: str, span: tuple[int, int, str]) -> tuple[int, int, str]:
    """The span without signs at its edges; a plus or paren in front of a phone number stays."""
    start, end, kind = span
    while end > start and not line[end - 1].isalnum():
        end -= 1
    while start < end and not (line[start].isalnum() or (kind == "phone" and line[start] in "+(")):
        start += 1
    return start, end, kind


def plausible(text: str, span: tuple[int, int, str]) -> bool:
    """What the marked words must hold at least to count as the kind they are marked with."""
    value = text[span[0] : span[1]]
    digits = len(NO_DIGIT.sub("", value))
    if span[2] == "email":
        return "." in value and SIGNAL.search(value) is not None and any(c.isalpha() for c in value)
    if span[2] == "ip":
        return value.count(".") == 3 or value.count(":") >= 3
    if span[2] == "card":
        return 12 <= digits <= 19 and luhn(NO_DIGIT.sub("", value))
    return 9 <= digits <= 15 and not any(c.isalpha() for c in value)


# --- the operator -----------------------------------------------------------------------------

WORDS_AT_A_TIME = 200_000


def spans_of(texts: list[str | None], decoder: Decoder) -> list[list[tuple[int, int, str, bool]]]:
    """All spans of each text: those of the patterns, and those the field adds."""
    out = [[(*s, True) for s in base_spans(t or "")] for t in texts]
    lines: list[str] = []
    origin: list[tuple[int, int]] = []

    def flush() -> None:
        for (number, begin), found in zip(origin, decoder.spans(lines)):
            fixed = [s for s in out[number] if s[3]]
            for start, end, kind in found:
                span = (start + begin, end + begin, kind)
                if not plausible(texts[number], span):
                    continue
                if not any(a < span[1] and span[0] < b for a, b, _, _ in fixed):
                    out[number].append((*span, False))
        lines.clear()
        origin.clear()

    held = 0
    for number, text in enumerate(texts):
        if not text or not SIGNAL.search(text):
            continue
        begin = 0
        for line in text.split("\n"):
            if SIGNAL.search(line):
                lines.append(line)
                origin.append((number, begin))
                held += len(line)
                if held > 6 * WORDS_AT_A_TIME:
                    flush()
                    held = 0
            begin += len(line) + 1
    flush()
    return [sorted(s, key=lambda x: (x[0], KINDS.index(x[2]))) for s in out]


@lru_cache(maxsize=1)
def _decoder(key: str, field_bytes: bytes) -> Decoder:
    return Decoder(pickle.loads(field_bytes))


def find(
    docs: DataFrame, field: Field | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: doc_id and its spans (kind, start, end in code points, base), by start, then kind."""
    held = pickle.dumps(train() if field is None else field)
    key = hashlib.sha256(held).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(held)  # some hundred kB, set by the labelled table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(key, shared.value)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = spans_of(part.column(1).to_pylist(), decoder)
                spans = pa.array([[(k, a, b, base) for a, b, k, base in s] for s in found], pa.list_(SPAN))
                yield pa.RecordBatch.from_arrays([part.column(0), spans], names=["doc_id", "spans"])

    return docs.select(
        docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text")
    ).mapInArrow(run, SPANS)


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
