"""Problem 8: text decoded with a wrong character encoding, found and restored by minimum description length."""

from __future__ import annotations

import re
from codecs import charmap_build, charmap_encode
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import log1p

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from clonewell.session import BROADCAST_BYTES, stage, unstage

RUN = re.compile(r"[^\x00-\x7f]+")
LOST = "�"

# Encodings a text may have been written in, and ones it may have been read in.
WRITTEN = ("utf-8", "cp1252", "mac_roman", "cp1251", "koi8-r", "cp866", "cp437", "cp850", "shift_jis", "euc_jp")
READ = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "koi8-r", "cp866")
# Those whose later bytes may be ASCII, so that a line can't be taken apart at its ASCII characters.
MIXED = ("shift_jis",)
# Cost of naming a stretch of a line; characters fewer that tell a garbled line when dictionaries are made; what stands around quotations, and around strings and asides too; words for that.
STRETCH_BYTES = 2.0
SURE_CHARS = 4
QUOTES = ("``", "“”", "«»")
MARKS = ("''", '""', "‘’", "()")
WORD = re.compile(r"[A-Za-z\x80-\U0010ffff]+")
SENTENCE = re.compile(r"(?<=[.!?]) |(?<=\u3002)")
# A text that isn't one character repeated takes as much, whatever is in the dictionary: headers of frame, block, literals and sequences, and one sequence.
LEAST_BYTES = 11
# Fixed value: where the East Asian blocks of Unicode begin.
LARGE = 0x2E80
# Levels of compression: the first for sentences; of a line that may be garbled, the shorter result counts, since no single way of parsing is best on all lines.
LEVELS = (12, 19)
NEAR_BYTES = 8
# How many runs, sentences or lines are remembered; characters of a line that is, and of a run.
REMEMBERED = 20_000
REMEMBERED_CHARS = 1_000
REMEMBERED_RUN = 100
# Characters of the lines, about, that are judged together when dictionaries are made; bytes that a sentence of a dictionary takes at least.
GROUP_CHARS = 1_000_000
SENTENCE_BYTES = 4


@dataclass(frozen=True)
class Settings:
    """``sample_bytes``, ``sample_line``: size, about, and longest line of what ``_sample`` draws, which the dictionaries don't depend on; sentences
    longer than ``sample_line`` characters have no place in a dictionary; ``dictionary_bytes``: size of one language's; ``languages``: how many have one;
    ``chain_bytes``: cost of naming a step of a chain and where it is; ``margin_bytes``: by how much a restored line must be
    shorter besides; ``lost_bytes``: both of these for a line that lost characters, which tells itself where."""

    sample_bytes: int = 6_000_000
    sample_line: int = 4_000
    dictionary_bytes: int = 65_536
    languages: int = 24
    chain_bytes: float = 2.0
    lost_bytes: float = 1.0
    margin_bytes: float = 1.0


def _byte_table(encoding: str) -> dict[str, int]:
    """Character -> byte; bytes that the encoding leaves open stand for themselves, as lenient readers have it."""
    table = {}
    for b in range(255, -1, -1):
        try:
            table[bytes([b]).decode(encoding)] = b
        except UnicodeDecodeError:
            table.setdefault(chr(b), b)
    return table


_TABLES = {e: _byte_table(e) for e in READ}
# The same tables for ``charmap_encode``; U+FFFE, which stands for no byte, where a byte has no character.
_MAPS = {e: charmap_build("".join({b: c for c, b in t.items()}.get(k, "\ufffe") for k in range(256))) for e, t in _TABLES.items()}
_OPEN = {e: [b for b in range(128, 256) if _TABLES[e].get(chr(b)) == b and e != "latin-1"] for e in READ}

Step = tuple[str, str]


def _chains() -> list[tuple[Step, ...]]:
    """Chains of (written as, read as), undone from the last step to the first."""
    single = [((a, b),) for a in WRITTEN for b in READ if a != b and {a, b} != {"cp1252", "latin-1"}]
    twice = [(("utf-8", a), ("utf-8", b)) for a in READ for b in READ if {a, b} <= {"cp1252", "latin-1", "mac_roman", "cp437", "cp1251"}]
    thrice = [(("utf-8", a),) * 3 for a in ("cp1252", "latin-1")]
    return single + twice + thrice


CHAINS = _chains()


def _undo(text: str, step: Step) -> str | None:
    """``text`` as it was before it was written as ``step[0]`` and read as ``step[1]``; None if that can't be."""
    written, read = step
    if LOST in text:  # a character lost in a byte the reader left open: only utf-8 tells which bytes fit
        if written != "utf-8":
            return None
        table = _TABLES[read]
        for b in _OPEN[read][::-1]:
            try:
                return bytes([table[c] if c != LOST else b for c in text]).decode("utf-8")
            except UnicodeDecodeError:
                continue
            except KeyError:
                return None
        return None
    try:
        return charmap_encode(text, "strict", _MAPS[read])[0].decode(written)
    except UnicodeError:
        return None


def _restore(text: str, chain: tuple[Step, ...]) -> str | None:
    for step in reversed(chain):
        if (text := _undo(text, step)) is None:
            return None
    return text


class _Codes(dict):
    """Bytes above ASCII for each character beyond it: three, and seven for those of the large alphabets of East Asia, so that two bytes read as
    one such character save nothing by themselves. Codes are spread by an odd factor, so that a character isn't cheap by its place in Unicode either."""

    def __missing__(self, c: int) -> str | int:
        x = c * 0x9E3779 & 0x1FFFFF
        code = chr(0x80 | x >> 14) + chr(0x80 | x >> 7 & 0x7F) + chr(0x80 | x & 0x7F)
        self[c] = c if c < 0x80 else code if c < LARGE else code + "".join(chr(0x80 | x >> 3 * k & 0x7F) for k in range(4))
        return self[c]


_CODES = _Codes({ord(d): ord("0") for d in "123456789"})


def _plain(text: str) -> bytes:
    """What is compressed: digits, which no chain changes, as 0."""
    return text.translate(_CODES).encode("latin-1")


_plain_remembered = lru_cache(REMEMBERED)(_plain)


def _plain_run(run: str) -> bytes:
    return _plain_remembered(run) if len(run) <= REMEMBERED_RUN else _plain(run)


@lru_cache(4 * REMEMBERED)
def _side(text: str, before: bool) -> str:
    """Of the two characters before or after a run, the ASCII ones next to it, digits as 0."""
    text = text if text.isascii() else text[1:] if before else text[:1]
    return re.sub(r"\d", "0", text) if text.isascii() else ""


def _beside(line: str, start: int, end: int) -> tuple[str, str]:
    """Up to two ASCII characters on either side, digits as 0."""
    return _side(line[max(0, start - 2) : start], True), _side(line[end : end + 2], False)


Context = tuple[str, str, str]


def _contexts(line: str) -> list[Context]:
    """Each run of non-ASCII characters with the ASCII characters on either side, digits as 0."""
    return [(b[0], m.group(), b[1]) for m in RUN.finditer(line) if (b := _beside(line, *m.span()))]


def _key(context: Context) -> Context:
    """What is counted of a context: of longer runs, only the run."""
    return context if len(context[1]) <= 3 else ("", context[1], "")


def _example(line: str, form: list[str | None]) -> bool:
    """Whether all words that would be restored stand quoted, or beside what they become; ``form``: each run restored or None.

    A letter by itself is an example too. Strings of code stand in quotation marks too, so there only single characters count as quoted.
    """
    parts = iter(form)
    for m in WORD.finditer(line):
        before = [(r.group(), next(parts)) for r in RUN.finditer(m.group())]
        if all(x is None for _, x in before):
            continue
        left = iter(before)
        word = RUN.sub(lambda r: next(left)[1] or r.group(), m.group())
        around = line[m.start() - 1 : m.start()] + line[m.end() : m.end() + 1]
        if not (around in QUOTES or (len(word) == 1 and (around in MARKS or word.isalpha())) or (None in form and word in line)):
            return False
    return True


class Model:
    """What correct text looks like: a compression dictionary per language, and which characters stand in a gap.
    """

    def __init__(self, dictionaries: dict[str, str], by_gap: dict[tuple[str, int, str], str], settings: Settings) -> None:
        self.dictionaries, self.by_gap, self.settings = dictionaries, by_gap, settings

    def size(self) -> int:
        return 4 * sum(map(len, self.dictionaries.values())) + 200 * len(self.by_gap)

    def coders(self, level: int) -> list:
        out = []
        for d in self.dictionaries.values():
            data = zstandard.ZstdCompressionDict(_plain(d), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            parameters = zstandard.ZstdCompressionParameters.from_level(level, write_checksum=False, write_content_size=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)
            data.precompute_compress(compression_params=parameters)
            out.append(zstandard.ZstdCompressor(dict_data=data, compression_params=parameters))
        return out


_LAST_STEPS = {step: [(k, chain[:-1]) for k, chain in enumerate(CHAINS) if chain[-1] == step and chain[0][0] not in MIXED] for step in dict.fromkeys(c[-1] for c in CHAINS)}
_WHOLE = [(k, chain) for k, chain in enumerate(CHAINS) if chain[0][0] in MIXED]


def _undone(run: str) -> dict[int, str]:
    """The run under each chain that can be undone on it, but for the chains that need a whole line. Chains share their last step."""
    return {k: r for step, chains in _LAST_STEPS.items() if chains and (last := _undo(run, step)) is not None for k, rest in chains if (r := _restore(last, rest)) is not None}


def _whole_lines(line: str) -> list[tuple[int, str]]:
    """(chain, restored line) of the chains that need a whole line; of those with the same result, the first."""
    out: dict[str, int] = {}
    for k, chain in _WHOLE:
        if (whole := _restore(line, chain)) is not None and not whole.isascii():
            out.setdefault(whole, k)
    return [(k, whole) for whole, k in out.items()]


def _pairs(text: str) -> set[str]:
    """Neighbouring characters of which one at least is beyond ASCII."""
    return {text[i : i + 2] for m in RUN.finditer(text) for i in range(max(0, m.start() - 1), min(m.end(), len(text) - 1))}


class Judge:
    """Describes lines under every chain. What a run, a sentence or a line comes to is remembered, for a bounded number of them."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._coders = model.coders(LEVELS[0])
        self._holding: dict[str, int] = {}  # neighbouring characters -> dictionaries that hold them, as bits
        for i, d in enumerate(model.dictionaries.values()):
            for pair in _pairs(d):
                self._holding[pair] = self._holding.get(pair, 0) | 1 << i
        self._thorough = model.coders(LEVELS[1])
        self._known: dict[tuple[str, str, str], list[tuple[str, int]]] = {}
        self._lines: dict[str, tuple[str, str, float] | None] = {}
        self._runs: dict[str, dict[int, str]] = {}
        self._costs: dict[str, int] = {}
        self._gains: dict[str, dict[int, int]] = {}

    def bytes_of(self, text: str, thorough: bool = False) -> int:
        """Length of ``text`` compressed with the dictionary that suits it best; if ``thorough``, at both levels, the second with the dictionaries that come near at the first."""
        raw = _plain(text)
        costs = [len(c.compress(raw)) for c in self._coders]
        best = min(costs, default=len(raw))
        if thorough:
            best = min([best, *(len(c.compress(raw)) for c, n in zip(self._thorough, costs) if n <= best + NEAR_BYTES)])
        return best

    def undone(self, run: str) -> dict[int, str]:
        found = self._runs.get(run)
        if found is None:
            if len(self._runs) > REMEMBERED:
                self._runs.clear()
            found = self._runs[run] = _undone(run)
        return found

    def repair(self, line: str) -> tuple[str, str, float] | None:
        """``repair_line``; what short lines come to is remembered, since many are repeated."""
        if len(line) > REMEMBERED_CHARS:
            return repair_line(line, self)
        if line not in self._lines:
            if len(self._lines) > REMEMBERED:
                self._lines.clear()
            self._lines[line] = repair_line(line, self)
        return self._lines[line]

    def known(self, left: str, run: str, right: str) -> list[tuple[str, int]]:
        """Neighbouring characters of a run between its neighbours that some dictionary holds, and which ones do, as bits."""
        found = self._known.get((left, run, right))
        if found is None:
            if len(self._known) > REMEMBERED:
                self._known.clear()
            found = [(p, self._holding[p]) for p in _pairs(left + run + right) if p in self._holding]
            if len(run) <= REMEMBERED_RUN:
                self._known[left, run, right] = found
        return found

    def least(self, sentence: str) -> int:
        """Bytes that the sentence takes beyond the least."""
        now = self._costs.get(sentence)
        if now is None:
            if len(self._costs) > 50_000:
                self._costs.clear()
            now = self._costs[sentence] = self.bytes_of(sentence)
        return now - LEAST_BYTES

    def gains(self, sentence: str) -> dict[int, int]:
        """Bytes by which each chain shortens the sentence if it is undone on the runs that allow it.

        A chain that makes the text no shorter gains only by a dictionary that holds one of the restored characters beside the
        same neighbour; the others describe the sentence as they did before, and aren't tried.
        """
        found = self._gains.get(sentence)
        if found is None:
            if len(self._gains) > REMEMBERED:
                self._gains.clear()
            found, now = {}, self.least(sentence) + LEAST_BYTES
            if now > LEAST_BYTES:
                between, runs = RUN.split(sentence), RUN.findall(sentence)
                undone, forms = [self.undone(r) for r in runs], {}
                for k in set().union(*undone):
                    forms.setdefault(tuple([u.get(k) or r for u, r in zip(undone, runs)]), []).append(k)
                ascii_ = [_plain(x) for x in between]
                for form, chains in forms.items():
                    if (cost := self._cost(sentence, between, ascii_, runs, form)) is not None:
                        found |= dict.fromkeys(chains, now - cost)
            self._gains[sentence] = found
        return found

    def _cost(self, sentence: str, between: list[str], ascii_: list[bytes], runs: list[str], form: tuple[str, ...]) -> int | None:
        """Bytes of the sentence with the runs of ``form`` for its ``runs``, by the dictionaries that may make it shorter; None if none may."""
        longer, holding = 0, 0
        for i, (run, restored) in enumerate(zip(runs, form)):
            if run != restored:
                longer += len(_plain_run(restored)) - len(_plain_run(run))
                for pair, which in self.known(between[i][-1:], restored, between[i + 1][:1]):
                    if which & ~holding and pair not in sentence:
                        holding |= which
        if longer >= 0 and not holding:
            return None
        raw = b"".join([x for pair in zip(ascii_, map(_plain_run, form)) for x in pair] + ascii_[-1:])
        return min((len(c.compress(raw)) for i, c in enumerate(self._coders) if longer < 0 or holding >> i & 1), default=None)

    def candidates(self, line: str) -> Iterator[tuple[int, str, int]]:
        """(chain, restored line, stretches) of the chains that may shorten the description; candidates with the same result once.

        A chain is undone on the whole line (``stretches`` 0), or, where some runs can't be undone or sentences don't gain by it, on the
        ``stretches`` of others. Runs that a chain makes an example of stay, and under all chains if it is one that undoes utf-8, which no single letter is by chance.
        """
        sentences = [re.sub("[0-9]", "0", x) for x in SENTENCE.split(line) if not x.isascii()]
        need = self.model.settings.chain_bytes + self.model.settings.margin_bytes
        if sum(map(self.least, sentences)) < need:
            return
        parts = [self.gains(x) for x in sentences]
        of_run = [i for i, x in enumerate(sentences) for _ in RUN.findall(x)]
        promising = [k for k in sorted(set().union(*parts)) if any(g.get(k, 0) > 0 for g in parts)]
        if not promising:
            return
        runs, forms, examples = [self.undone(r) for r in RUN.findall(line)], [], set()
        for k in promising:
            whole = [r.get(k) for r in runs]
            part = [x if parts[p].get(k, 0) > 0 else None for x, p in zip(whole, of_run)]
            for form in [whole, part] if None not in whole and whole != part else [part]:
                changed = {i for i, x in enumerate(form) if x is not None}
                if _example(line, form):
                    examples |= changed if CHAINS[k][0][0] == "utf-8" else set()
                elif changed:
                    forms.append((k, form, changed))
        seen = {line}
        for k, form, changed in forms:
            left = iter(form)
            out = RUN.sub(lambda m: next(left) or m.group(), line)
            if out not in seen and not changed <= examples:
                seen.add(out)
                yield k, out, 0 if len(changed) == len(runs) else sum(i - 1 not in changed for i in changed)


def _lost_marks(line: str) -> bool:
    """Whether marks of lost characters stand in the line other than as a quotation of the mark."""
    quoted = re.sub("([`'\"])" + LOST + r"+\1|[“‘«(]" + LOST + r"+[”’»)]|\b0x?fffd\b", "", line, flags=re.I)
    return LOST in quoted


def repair_line(line: str, judge: Judge) -> tuple[str, str, float] | None:
    """(restored line, chain, bytes saved) if a chain describes the line better than leaving it, else None.

    Each sentence is described under every chain. Chains that shorten some sentence are then tried on the line as a whole; those that come near
    the shortest description at the first level are compared at both.
    """
    s, lost = judge.model.settings, _lost_marks(line)
    options = [(len(CHAINS[k]) * s.chain_bytes + n * STRETCH_BYTES, out, k) for k, out, n in judge.candidates(line)]
    if whole := _whole_lines(line):
        now = judge.bytes_of(line)
        options += [(len(CHAINS[k]) * s.chain_bytes, out, k) for k, out in whole if now - judge.bytes_of(out) >= s.chain_bytes]
    if lost:
        options.append((s.lost_bytes, _fill(line, judge.model), -1))
    if not options:
        return None
    # the marks of lost characters say nothing once the loss is stated, so they cost nothing then
    described = [(judge.bytes_of(seen := o.replace(LOST, "") if k < 0 else o) + price, seen, price, o, k) for price, o, k in options]
    best = min(described)[0]
    now = judge.bytes_of(line, thorough=True)
    cost, out, k = min(((judge.bytes_of(seen, thorough=True) + price, o, k) for n, seen, price, o, k in described if n <= best + NEAR_BYTES), key=lambda x: x[0])
    return (out, _name(k), now - cost) if now - cost >= (s.lost_bytes if k < 0 else s.margin_bytes) else None


def _name(k: int) -> str:
    return "lost" if k < 0 else " < ".join(f"{a} as {b}" for a, b in CHAINS[k])


GAP = re.compile(LOST + "{1,3}(?!" + LOST + ")")


def _gap(line: str, m: re.Match) -> tuple[str, str, str]:
    left, right = _beside(line, *m.span())
    return left, m.group(), right


def _fill(line: str, model: Model) -> str:
    """Lost characters put back where the characters around them occur with one run of that length only."""

    def put(m: re.Match) -> str:
        left, gap, right = _gap(line, m)
        return model.by_gap.get((left, len(gap), right)) or gap

    return GAP.sub(put, line)


def usage_of(lines: Iterable[str], settings: Settings = Settings()) -> Counter:
    """(what, left, middle, right) -> number of lines: ``run``s in context and ``gap``s of lost characters; ``size``: characters of the lines that may be samples."""
    counts: Counter = Counter()
    for line in lines:
        found = {("run", *_key(c)) for c in _contexts(line)}
        if LOST in line:
            found |= {("gap", left, "x" * len(gap), right) for left, gap, right in map(lambda m: _gap(line, m), GAP.finditer(line))}
        counts.update(found)
        if len(line) <= settings.sample_line:
            counts["size", "", "", ""] += len(line)
    return counts


_CONTEXT = "left string, run string, right string"


def train(lines: DataFrame, usage: DataFrame, by_gap: dict[tuple[str, int, str], str], settings: Settings) -> Model:
    """The model from ``lang, line`` of all distinct lines, most of which are correct, and their ``usage``.

    A line is taken for garbled and left out if some chain turns those of its runs that it can be undone on into ones
    that stand in more lines, or if undoing utf-8 takes several characters away. So garbled text doesn't enter the dictionaries, but text that quotes
    garbled sequences does, since its restored form occurs nowhere. Lines are judged in tasks, in groups of about ``GROUP_CHARS``, beside
    the counts of the contexts that a group asks for; sentences are counted over all lines, and what comes to the driver are the dictionaries.
    """
    names = [x.split()[0] for x in _CONTEXT.split(", ")]
    groups = -(-(lines.agg(F.sum(F.length("line"))).first()[0] or 0) // GROUP_CHARS) or 1
    lines = lines.select("lang", "line", F.pmod(F.xxhash64("line", F.lit(7)), F.lit(groups)).alias("part"))

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forms = Forms()
        for batch in batches:
            found: dict[int, set[Context]] = {}
            for g, line in zip(batch["part"].tolist(), batch["line"]):
                found.setdefault(g, set()).update(*(forms.of(c).keys for c in _contexts(line)), *(map(_key, _contexts(whole)) for _, whole in _whole_lines(line)))
            columns = list(zip(*((g, *c) for g, contexts in found.items() for c in contexts))) or [()] * 4
            yield pd.DataFrame(dict(zip(["part", *names], columns)))

    known = lines.select("part", "line").mapInPandas(asked, "part bigint, " + _CONTEXT).distinct().join(usage.where("what = 'run'").select(*names, "n"), names)

    forms = Forms()  # one in each task, for all its groups

    def correct(group: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        usual, judged, found = dict(zip(zip(*(counts[x] for x in names)), map(log1p, counts["n"]))), {}, []
        for lang, line in zip(group["lang"], group["line"]):
            if LOST in line or _taken_for_garbled(line, forms, usual, judged):
                continue
            found += [(lang, re.sub("[0-9]", "0", x), len(_plain(x)) + 1) for x in SENTENCE.split(line) if not x.isascii() and len(x) <= settings.sample_line]
        return pd.DataFrame(found, columns=["lang", "sentence", "size"])

    each = lines.groupBy("part").cogroup(known.groupBy("part")).applyInPandas(correct, "lang string, sentence string, size bigint")
    sentences = stage(each.groupBy("lang", "sentence").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size")), "sentences")
    # the most frequent ones of each language, as far as there is room, so no more than have room if all are of the least size
    order = W.partitionBy("lang").orderBy(F.desc("n"), "sentence")
    first = sentences.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.dictionary_bytes // SENTENCE_BYTES)
    kept = stage(first.withColumn("upto", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0))).where(F.col("upto") <= settings.dictionary_bytes).select("lang", "sentence", "n"), "kept")
    weights = sentences.groupBy("lang").agg(F.sum("n").alias("weight")).join(kept.select("lang").distinct(), "lang", "left_semi")
    texts: dict[str, list[str]] = {r.lang: [] for r in weights.orderBy(F.desc("weight"), "lang").limit(settings.languages).collect()}
    for r in kept.where(F.col("lang").isin(list(texts))).orderBy("n", F.desc("sentence")).collect():
        texts[r.lang].append(r.sentence)  # the most frequent ones last, where they are cheapest to point at
    unstage(sentences)
    unstage(kept)
    return Model({lang: "\n".join(x) for lang, x in texts.items()}, by_gap, settings)


@dataclass(frozen=True, slots=True)
class Form:
    """A run in context: ``own`` is what is counted of it, ``restored`` that of the run under each chain that can be undone on it, ``shorter``
    how many characters undoing utf-8 takes away, ``keys`` all that is counted of these."""

    own: Context
    restored: dict[int, Context]
    shorter: dict[int, int]
    keys: frozenset[Context]


class Forms:
    """What the chains make of runs in context, remembered for a bounded number of them."""

    def __init__(self) -> None:
        self._seen: dict[Context, Form] = {}
        self._runs: dict[str, dict[int, str]] = {}

    def of(self, context: Context) -> Form:
        found = self._seen.get(context)
        if found is None:
            if len(self._seen) > REMEMBERED // 2:
                self._seen.clear()
                self._runs.clear()
            left, run, right = context
            undone = self._runs[run] if run in self._runs else self._runs.setdefault(run, _undone(run))
            by_text = {r: _key((left, r, right)) for r in undone.values()}
            shorter = {k: len(run) - len(r) for k, r in undone.items() if CHAINS[k][0][0] == "utf-8"}
            own = _key(context)
            found = self._seen[context] = Form(own, {k: by_text[r] for k, r in undone.items()}, shorter, frozenset([own, *by_text.values()]))
        return found


def _taken_for_garbled(line: str, forms: Forms, usual: dict[Context, float], judged: dict[Context, tuple[float, list[int]]]) -> bool:
    """Whether some chain makes the runs that it can be undone on more ``usual`` on the average, or takes several characters away by undoing utf-8.

    ``judged`` remembers of each context how usual it is, and the chains that make it more so or shorter: a line has to be described
    only under chains that do so in one of its contexts, since the others can't raise the average.
    """
    contexts = _contexts(line)
    for c in contexts:
        if c not in judged:
            form = forms.of(c)
            at = usual.get(form.own, 0.0)
            judged[c] = at, [k for k, key in form.restored.items() if k in form.shorter or usual.get(key, 0.0) > at]
    at = [judged[c][0] for c in contexts]
    if chains := set().union(*(judged[c][1] for c in contexts)):
        made = [forms.of(c) for c in contexts]
        for k in chains:
            which = [i for i, form in enumerate(made) if k in form.restored]
            if sum(made[i].shorter.get(k, 0) for i in which) >= SURE_CHARS or sum(usual.get(made[i].restored[k], 0.0) for i in which) / len(which) > sum(at[i] for i in which) / len(which) + 0.2:
                return True
    for _, whole in _whole_lines(line):
        restored = [usual.get(_key(c), 0.0) for c in _contexts(whole)]
        if sum(restored) / max(1, len(restored)) > sum(at) / len(at) + 0.2:
            return True
    return False


def language_of(lang: Column) -> Column:
    """Lower-case language code without region; ``und`` for null or blank."""
    return F.coalesce(F.nullif(F.regexp_extract(F.lower(F.trim(lang)), "^([a-z]+)", 1), F.lit("")), F.lit("und"))


def find_garbled(documents: DataFrame, doc_id: Column, text: Column, lang: Column, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, chains, n_lines, bytes_saved, lossy, restored`` for every document with wrongly decoded lines.

    Every line with characters beyond ASCII is described by its length when compressed with a
    zstandard dictionary of correct text, the best of one per language. Each chain of wrong readings
    (written as A, read as B, up to three times) that can be undone gives a candidate, whose
    description is its compressed length plus the chain's cost; marks of characters that were lost are
    explained by a chain of their own. All candidates are compressed, word by word; lines with a word that some chain shortens are
    compressed whole under every chain, undone on the whole line or on the stretches that gain. The shortest description wins; the line stays as it is unless one
    is shorter by ``margin_bytes``. ``restored`` is the whole text with its garbled lines restored;
    ``lossy`` tells that some characters could not be.

    Documents are read twice: for their distinct lines beyond ASCII, which are staged, and for the one map over texts, which aren't shuffled.
    Runs in context, what stands in a gap and the sentences of the dictionaries are counted over all distinct lines. The dictionaries and the gaps that occur are broadcast with a size check.

    Null, empty and plain ASCII texts are never affected; a line that quotes garbled sequences stays,
    as the quotation is shorter as it is; repeated documents each give a row; an empty table gives
    none; null ids are ignored.
    """
    spark = documents.sparkSession
    docs = documents.select(doc_id.alias("doc_id"), text.alias("text"), language_of(lang).alias("lang")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    lines = stage(_lines(docs), "lines")
    usage = stage(_usage(lines, settings), "usage")
    by_gap = {(r.left, r.k, r.right): r.run for r in _gaps(usage).collect()}
    model = train(lines, usage, by_gap, settings)
    unstage(lines)
    unstage(usage)
    if model.size() > BROADCAST_BYTES:
        raise ValueError(f"a model of {model.size()} bytes is too large to broadcast; lower dictionary_bytes")
    sent = spark.sparkContext.broadcast(model)

    def restore(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = Judge(sent.value)
        for batch in batches:
            found = []
            for d, t in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                if t.isascii():
                    continue
                lines, chains, saved, n = t.split("\n"), set(), 0.0, 0
                for k, line in enumerate(lines):
                    if not line.isascii() and (r := judge.repair(line)):
                        lines[k], n, saved = r[0], n + 1, saved + r[2]
                        chains.add(r[1])
                if n:
                    found.append((d, sorted(chains), n, saved, "lost" in chains or LOST in "".join(lines), "\n".join(lines)))
            yield pd.DataFrame(found, columns=["doc_id", "chains", "n_lines", "bytes_saved", "lossy", "restored"])

    return docs.select("doc_id", "text").mapInPandas(restore, "doc_id bigint, chains array<string>, n_lines int, bytes_saved double, lossy boolean, restored string")


def _lines(docs: DataFrame) -> DataFrame:
    """``line, lang``: the distinct lines with characters beyond ASCII."""
    each = docs.select("lang", F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(r"[^\x00-\x7F]"))
    return each.groupBy("line").agg(F.min("lang").alias("lang"))


def _usage(lines: DataFrame, settings: Settings) -> DataFrame:
    """``what, left, run, right, n``: ``usage_of`` distinct lines, so that copies of a text don't make it usual."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(*c, n) for c, n in usage_of(batch["line"], settings).items()], columns=["what", "left", "run", "right", "n"])

    parts = lines.select("line").mapInPandas(count, "what string, left string, run string, right string, n bigint")
    return parts.groupBy("what", "left", "run", "right").agg(F.sum("n").alias("n"))


def _gaps(usage: DataFrame) -> DataFrame:
    """``left, k, right, run``: for the gaps of lost characters that occur, the run of that length which stands there in more than nine of ten cases."""
    key = ["left", "k", "right"]
    asked = usage.where("what = 'gap'").select("left", F.length("run").alias("k"), "right").distinct()
    runs = usage.where((F.col("what") == "run") & (F.length("run") <= 3) & ~F.col("run").contains(LOST))
    by = runs.withColumn("k", F.length("run")).join(asked, key, "left_semi").groupBy(*key)
    best = by.agg(F.max_by("run", F.struct("n", "run")).alias("run"), F.max("n").alias("most"), F.sum("n").alias("n"))
    return best.where("most > 1 AND most > 0.9 * n").select(*key, "run")


def hash_bound(total: int, wanted: int) -> int:
    """Below which the upper 62 bits of a hash must lie so that a part ``wanted`` of ``total`` is drawn; it doesn't vanish before ``total`` is 4e18 times as large."""
    return 1 << 62 if total <= wanted else max(1, (wanted << 62) // total)


def _sample(lines: DataFrame, usage: DataFrame, settings: Settings) -> DataFrame:
    """``lang, line``: about ``sample_bytes`` of characters of the distinct lines, for a look at them; ``find_garbled`` takes all."""
    total = usage.where("what = 'size'").agg(F.sum("n")).first()[0] or 0
    return lines.where((F.shiftrightunsigned(F.xxhash64("line", F.lit(5)), 2) < hash_bound(total, settings.sample_bytes)) & (F.length("line") <= settings.sample_line)).select("lang", "line")
