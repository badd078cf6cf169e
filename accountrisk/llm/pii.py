"""Personal data: base patterns, and a linear-chain conditional random field over word shapes.

The base finds e-mail addresses, IPv4 addresses, payment cards and international phone numbers by pattern and
check. The field, trained on the driver from a small labelled table (``LABELLED``), adds forms the patterns
miss: phones without a country code, and secrets (access tokens, keys and passwords), a kind of the field alone that has
no pattern. What it adds must pass the kind's check and never touches a base span.

Decoding is exact Viterbi over all tokens of a text: numpy computes shapes and label scores of a whole batch;
a token is surely "none" when no stretch of other labels around it can gain more than entering and leaving the
stretch costs, so paths are only computed for the runs between such tokens, many runs at a time.

Texts of a batch are one sequence with two places outside any text between them, so a text's spans are the same alone
and beside others.

Cases: null and empty texts have no spans; texts are never cut; rows are independent, so repeated ids and ties
do not matter; extra columns stay, one with the name of a result column is replaced.
"""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountrisk.llm.common import steps, trimmed

KINDS = ["email", "ip", "card", "phone"]
FIELD_KINDS = [*KINDS, "secret"]
#: Text bytes labelled together.
STEP_TEXT_BYTES = 2_000_000

# ---- base patterns ------------------------------------------------------------------------------------
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @: the local part is the whole run before it, up to the last match."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            out.append((start, domain.end()))
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".")
        start = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                out.append((start, end))
            start = end + 1
    return out


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        d = digits_of(m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    finders = (emails, addresses, cards, phones)
    return [(k, a, b) for k, find in enumerate(finders) for a, b in find(text)]


# ---- word shapes --------------------------------------------------------------------------------------
_SYMBOLS = "@.+-_()[]/:,;#*$%&|=\"'!?<>{}\\^~`"
LOWER, UPPER, DIGIT, SPACE, LINE, OTHER = 0, 1, 2, 3, 4, 5
_CLASS = np.full(129, OTHER, np.int16)
_CLASS[ord("a") : ord("z") + 1], _CLASS[ord("A") : ord("Z") + 1], _CLASS[ord("0") : ord("9") + 1] = LOWER, UPPER, DIGIT
_CLASS[128] = LOWER  # letters of other scripts
_CLASS[[9, 11, 12, 13, 32]] = SPACE
_CLASS[10] = LINE
for _k, _c in enumerate(_SYMBOLS):
    _CLASS[ord(_c)] = OTHER + 1 + _k
_WORD_BASE = OTHER + 1 + len(_SYMBOLS)  # shapes below are line feeds and symbols, from here on words by length
_LENGTHS = np.array([0, 1, 2, 3, 4, 4, 4, 5, 5, 5, 5, 6])  # 1, 2, 3, 4-6, 7-10, more
N_WORDS = 7 * 4
N_SHAPES = 2 * (_WORD_BASE + N_WORDS)  # twice: white space before the token or not
EDGE = N_SHAPES  # shape outside the text


def tokens_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, shapes) of a text's tokens: runs of letters, runs of digits, single other characters."""
    cls = _CLASS[np.minimum(codes, 128)]
    group = np.where(cls == UPPER, LOWER, cls)
    change = np.empty(len(codes), bool)
    change[:1] = True
    change[1:] = (group[1:] != group[:-1]) | (group[1:] >= LINE)
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(codes))
    kind = group[starts]
    word = kind <= DIGIT
    length = _LENGTHS[np.minimum(ends - starts, 11)]
    # exact digit counts up to four matter, letters are told apart by their first capital
    form = np.where(kind == DIGIT, 2, np.where(cls[starts] == UPPER, 1, 0))
    fine = np.minimum(ends - starts, 6)
    shape = np.where(word, _WORD_BASE + form * 7 + np.where(form == 2, fine, length), kind)
    spaced = np.append(False, kind[:-1] == SPACE) if len(kind) else np.zeros(0, bool)
    keep = kind != SPACE
    return starts[keep], ends[keep], (shape + (N_SHAPES // 2) * spaced)[keep]


# ---- the field ----------------------------------------------------------------------------------------
N_LABELS = 1 + len(FIELD_KINDS)  # none, then the kinds
_MASKED = -1e9


class Field:
    """Scores of labels from the token's shape and its pairs with the shapes on both sides; label transitions."""

    def __init__(self):
        s = N_SHAPES + 1
        self.own = np.zeros((s, N_LABELS))
        self.before = np.zeros((s * s, N_LABELS))
        self.after = np.zeros((s * s, N_LABELS))
        self.before2 = np.zeros((s * s, N_LABELS))
        self.after2 = np.zeros((s * s, N_LABELS))
        self.move = np.zeros((N_LABELS, N_LABELS))

    def parts(self, shapes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        s = N_SHAPES + 1
        pad = np.concatenate([[EDGE, EDGE], shapes, [EDGE, EDGE]])
        b2, b, o, a, a2 = (pad[k : k + len(shapes)] for k in range(5))
        return [(self.own, o), (self.before, b * s + o), (self.after, o * s + a), (self.before2, b2 * s + o), (self.after2, o * s + a2)]

    def scores(self, shapes: np.ndarray) -> np.ndarray:
        return sum(table[index] for table, index in self.parts(shapes))


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(rows: list[tuple[np.ndarray, np.ndarray]], rounds: int = 40, rate: float = 0.3, decay: float = 2e-4) -> Field:
    """Maximum likelihood with weight decay; gradient steps scaled by each weight's past gradients (Adagrad)."""
    field = Field()
    past = {id(t): np.full(t.shape, 1e-6) for t in (field.own, field.before, field.after, field.before2, field.after2, field.move)}
    order = random.Random(7)
    rows = list(rows)
    for _ in range(rounds):
        order.shuffle(rows)
        for shapes, labels in rows:
            e, n = field.scores(shapes), len(shapes)
            ahead, back = np.zeros((n, N_LABELS)), np.zeros((n, N_LABELS))
            ahead[0] = e[0]
            for t in range(1, n):
                ahead[t] = e[t] + log_sum(ahead[t - 1][:, None] + field.move, 0)
            for t in range(n - 2, -1, -1):
                back[t] = log_sum(field.move + (e[t + 1] + back[t + 1])[None, :], 1)
            total = log_sum(ahead[-1], 0)
            g = np.exp(ahead + back - total)
            g[np.arange(n), labels] -= 1
            gm = np.zeros_like(field.move)
            if n > 1:
                pair = ahead[:-1, :, None] + field.move[None] + (e[1:] + back[1:])[:, None, :] - total
                gm = np.exp(pair).sum(0)
                np.subtract.at(gm, (labels[:-1], labels[1:]), 1)
            for table, index in field.parts(shapes):
                keys, where = np.unique(index, return_inverse=True)
                own = np.zeros((len(keys), N_LABELS))
                np.add.at(own, where, g)
                own += decay * table[keys]
                past[id(table)][keys] += own**2
                table[keys] -= rate * own / np.sqrt(past[id(table)][keys])
            gm += decay * field.move
            past[id(field.move)] += gm**2
            field.move -= rate * gm / np.sqrt(past[id(field.move)])
    return field


def best_paths(e: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best labels of runs, e (runs, longest, labels); each run is entered from and left to label 0."""
    runs, longest, _ = e.shape
    score = e[:, 0] + move[0]
    back = np.zeros((runs, longest, N_LABELS), np.int8)
    final = np.zeros((runs, N_LABELS))
    final[lengths == 1] = score[lengths == 1]
    for t in range(1, longest):
        options = score[:, :, None] + move[None]
        back[:, t] = options.argmax(1)
        score = options.max(1) + e[:, t]
        final[lengths == t + 1] = score[lengths == t + 1]
    label = (final + move[:, 0]).argmax(1)
    out = np.zeros((runs, longest), np.int8)
    for t in range(longest - 1, -1, -1):
        inside = t < lengths
        out[inside, t] = label[inside]
        step = inside & (t > 0)
        label = np.where(step, back[np.arange(runs), t, label], label)
    return out


def viterbi(field: Field, shapes: np.ndarray) -> np.ndarray:
    """Best labels of one long sequence that begins and ends in label 0."""
    labels = np.zeros(len(shapes), np.int8)
    if not len(shapes):
        return labels
    e = field.scores(shapes)
    e[((shapes % (N_SHAPES // 2)) == LINE) | (shapes == EDGE), 1:] = _MASKED
    # a stretch of other labels gains at most its leads, and what moves inside, into and out of it can add
    move, none = field.move, field.move[0, 0]
    gain = e[:, 1:].max(1) - e[:, 0] + (move[1:, 1:].max() - none)
    needed = (move[1:, 1:].max() - none) - (move[0, 1:].max() - none) - (move[1:, 0].max() - none)
    total = np.cumsum(np.maximum(gain, -1e4))
    before = np.append(0.0, total[:-1])
    ahead = total - np.minimum.accumulate(before)  # best stretch that ends here
    behind = np.maximum.accumulate(total[::-1])[::-1] - before  # best stretch that begins here
    open_ = ahead + behind - np.maximum(gain, -1e4) >= needed - 1e-6
    edge = np.flatnonzero(np.diff(np.concatenate([[0], open_.astype(np.int8), [0]])))
    starts, lengths = edge[::2], edge[1::2] - edge[::2]
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        # runs of like lengths together, at most about a million cells
        end = at + 1
        while end < len(order) and (end + 1 - at) * lengths[order[end]] <= 200_000 and lengths[order[end]] <= 2 * lengths[order[at]] + 8:
            end += 1
        pick = order[at:end]
        n, longest = lengths[pick], int(lengths[order[end - 1]])
        cells = np.minimum(starts[pick][:, None] + np.arange(longest), len(shapes) - 1)
        paths = best_paths(e[cells], n, field.move)
        inside = np.arange(longest) < n[:, None]
        labels[cells[inside]] = paths[inside]
        at = end
    return labels


def passes(kind: int, text: str) -> bool:
    """What a span of the field must hold to count."""
    d = digits_of(text)
    if FIELD_KINDS[kind] == "secret":
        return len(text) >= 16 and 4 <= len(d) <= len(text) - 4 and bool(re.fullmatch(r"[A-Za-z0-9]+", text))
    if KINDS[kind] == "email":
        return bool(re.fullmatch(r"[^\s@]+\s?(?:@|[(\[]\s?at\s?[)\]])\s?[^\s@]+(?:\.|\s?[(\[]\s?dot\s?[)\]]\s?)[A-Za-z]{2,}", text))
    if KINDS[kind] == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if KINDS[kind] == "card":
        return 13 <= len(d) <= 19 and luhn(d) and len(text) <= 2 * len(d)
    return 9 <= len(d) <= 15 and len(text) <= 2 * len(d) and bool(re.search(r"[0-9][^0-9]+[0-9]", text))


_RUN_AFTER = re.compile(r"[A-Za-z0-9]*")


def run_start(text: str, at: int) -> int:
    """Where the run of letters and digits that ends at ``at`` begins."""
    while at and text[at - 1].isalnum() and text[at - 1] < "\x80":
        at -= 1
    return at


def field_spans(field: Field, codes: np.ndarray, text: str, start: int, base: list[tuple[int, int, int]], found) -> list[tuple[int, int, int]]:
    """Spans that the labels of a text's tokens give, beside the base spans. found: starts, ends, labels."""
    starts, ends, labels = found
    hot = np.flatnonzero(labels)
    if not len(hot):
        return []
    cuts = np.flatnonzero((np.diff(hot) != 1) | (np.diff(labels[hot]) != 0))
    out = []
    for a, b in zip(np.append(0, cuts + 1).tolist(), np.append(cuts, len(hot) - 1).tolist(), strict=True):
        kind = int(labels[hot[a]]) - 1
        s, t = int(starts[hot[a]]) - start, int(ends[hot[b]]) - start
        if FIELD_KINDS[kind] == "secret":  # a secret is a whole run of letters and digits
            if out and out[-1][0] == kind and s < out[-1][2]:
                continue
            s, t = run_start(text, s), _RUN_AFTER.match(text, t).end()
        apart = not text[max(0, s - 1) : s].isalnum() and not text[t : t + 1].isalnum()
        if apart and not any(x < t and s < y for _, x, y in base) and passes(kind, text[s:t]):
            out.append((kind, s, t))
    return out


# ---- the labelled table -------------------------------------------------------------------------------
#: Sentences with {kind:form} places; forms are filled with drawn digits (#) and hexadecimal ones (%). Plain numbers stand for what is no
#: personal data.
LABELLED = [
    "call {phone:(###) ###-####} after six",
    "Phone: {phone:###-###-####}.",
    "reach me on {phone:### ### ####} or write",
    "tel. {phone:0## ### ## ##} on work days",
    "fax {phone:(0##) ###-####}, room 12",
    "our number is {phone:+## ### ### ####} today",
    "line {phone:+# (###) ###-####} is open",
    "mobile {phone:0### ######}",
    "dial {phone:###.###.####} now",
    "write to {email:ab.cd (at) mail.example.com} soon",
    "contact {email:info [at] example [dot] org} for more",
    "mail {email:x##@mail#.example.com} or call",
    "send it to {email:name@example.org}, please",
    "address {email:first_last@host-##.example.net}",
    "server {ip:10.##.##.2} was down",
    "from {ip:1##.0.1#.5} to {ip:1##.1.1#.9}",
    "host {ip:10[.]##[.]1#[.]2} blocked",
    "paid by {card:####.####.####.####} in May",
    "card {card:#### #### #### ####} expires",
    "number {card:####-####-####-####}, thanks",
    "account {card:################} was used",
    "in 19## there were 2#0# of them",
    "version 2.0 of the license",
    "licensed under version 3.",
    "it costs 1#.99 or 2,#00 in all",
    "chapter 3.1.4 on page #12",
    "on 2021-0#-1# at 12:3# and 13:0#",
    "release 1.2.3-#4 is out",
    'token = "{secret:%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%}" here',
    "token = '{secret:%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%}'",
    'the api_key: "{secret:%%%%%%%%%%%%%%%%%%%%%%%%}" is old',
    "secret={secret:%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%} and more",
    "use key {secret:%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%%} for it",
    'Password = "{secret:%%%%%%%%%%%%%%%%%%%%}".',
    'code = "#ab" and colour "#f#f##" here',
    'the word "Stone" and the year "19##" stand here',
    "the value ############ is odd",
    "rows 1-#0 and 20-3#, sum 4#",
    "see (12) and (3) or [4]",
    "a # b ## c ### d #### e",
    "no numbers at all in this one.",
    "The words, Of any | kind | stand !! here ### or $$$ there&&&",
    "id ####-## and code ##/##",
    "1#% of 2# and ## x ##",
    "he was here, she at work (not far) and so on",
    "score 1#-1# in 200# against 1#",
    "part no. ##-###-# for model ####",
]


def training_rows(copies: int = 5) -> list[tuple[np.ndarray, np.ndarray]]:
    """(shapes, labels) of the labelled table, each sentence filled ``copies`` times."""
    draw = random.Random(20)
    rows = []
    for _ in range(copies):
        for sentence in LABELLED:
            text, spans = "", []
            for piece in re.split(r"(\{\w+:[^}]*\})", sentence):
                form = re.fullmatch(r"\{(\w+):(.*)\}", piece)
                filled = re.sub("[#%]", lambda m: str(draw.randrange(10)) if m[0] == "#" else draw.choice("0123456789abcdef"), form[2]) if form else re.sub(r"(?<![# ])#|#(?=[#0-9.\-])", lambda _: str(draw.randrange(10)), piece)
                if form:
                    spans.append((FIELD_KINDS.index(form[1]), len(text), len(text) + len(filled)))
                text += filled
            starts, ends, shapes = tokens_of(np.frombuffer(text.encode("utf-32-le"), np.uint32))
            labels = np.zeros(len(shapes), np.int64)
            for k, a, b in spans:
                labels[(starts >= a) & (ends <= b)] = k + 1
            rows.append((shapes, labels))
    return rows


def parted(starts: np.ndarray, ends: np.ndarray, shapes: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens with two places outside any text where a border between texts stands (a line feed of its own)."""
    border = np.searchsorted(starts, borders)
    shapes = shapes.copy()
    shapes[border] = EDGE
    times = np.ones(len(starts), np.int64)
    times[border] = 2
    return tuple(np.repeat(x, times) for x in (starts, ends, shapes))


def spans_in(field: Field, texts: list[str]) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """(base spans, all spans) of each text, as (kind number, start, end) by kind, then start."""
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts, ends, shapes = tokens_of(codes)
    edges = np.append(0, np.cumsum([len(t) + 1 for t in texts]))
    starts, ends, shapes = parted(starts, ends, shapes, edges[1:] - 1)
    labels = viterbi(field, shapes)
    hot = np.flatnonzero(labels)
    cuts = np.searchsorted(starts[hot], edges)
    out = []
    for k, text in enumerate(texts):
        own = base_spans(text)
        mine = hot[cuts[k] : cuts[k + 1]]
        more = []
        if len(mine):
            a, b = mine[0], mine[-1] + 1
            more = field_spans(field, codes, text, int(edges[k]), own, (starts[a:b], ends[a:b], labels[a:b]))
        out.append((own, sorted(own + more)))
    return out


def find_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``pii``, arrays of (kind, start, end): the base spans, and all spans. Both in the
    order of ``FIELD_KINDS``, then start; code points, end exclusive."""
    field = docs.sparkSession.sparkContext.broadcast(train(training_rows()))
    base = docs.drop("base", "pii").withColumn(text_col, F.col(text_col).cast("string"))
    at = base.columns.index(text_col)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows(spans):
        return [{"kind": FIELD_KINDS[k], "start": a, "end": b} for k, a, b in spans]

    def run(batches):
        for batch in batches:
            for part in steps(batch, batch.schema.names[at], STEP_TEXT_BYTES):
                found = spans_in(field.value, [t or "" for t in part.column(at).to_pylist()])
                first, full = ([rows(s[k]) for s in found] for k in (0, 1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(first, kind), pa.array(full, kind)], [*part.schema.names, "base", "pii"])

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    schema = base.select("*", F.lit(None).cast(spans).alias("base"), F.lit(None).cast(spans).alias("pii")).schema
    return base.mapInArrow(run, schema)


def without_spans(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each (kind, start, end) replaced by its kind in angle brackets; overlapping spans go as one."""
    if not text or not spans:
        return text
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, text_col: str = "text", spans_col: str = "pii") -> DataFrame:
    """Each span of ``spans_col`` replaced by its kind in angle brackets; overlapping spans go as one."""
    at, spans_at = docs.columns.index(text_col), docs.columns.index(spans_col)

    def cleaned(text: str | None, spans: list[dict] | None) -> str | None:
        return without_spans(text, [(s["kind"], s["start"], s["end"]) for s in spans or []])

    def run(batches):
        for batch in batches:
            column = pa.array([cleaned(t, s) for t, s in zip(batch.column(at).to_pylist(), batch.column(spans_at).to_pylist(), strict=True)], pa.string())
            yield batch.set_column(at, batch.schema.names[at], column)

    return docs.mapInArrow(run, docs.schema)


def find_and_redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The texts that :func:`find_pii` and then :func:`redact` give, in one pass: a task has one Python worker, not two
    side by side. All other columns stay."""
    field = docs.sparkSession.sparkContext.broadcast(train(training_rows()))
    base = docs.withColumn(text_col, F.col(text_col).cast("string"))
    at = base.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in steps(batch, batch.schema.names[at], STEP_TEXT_BYTES):
                texts = part.column(at).to_pylist()
                found = spans_in(field.value, [t or "" for t in texts])
                clean = [without_spans(t, [(FIELD_KINDS[k], a, b) for k, a, b in full]) for t, (_, full) in zip(texts, found, strict=True)]
                yield part.set_column(at, part.schema.names[at], pa.array(clean, pa.string()))

    return base.mapInArrow(trimmed(run), base.schema)
