"""Language-model scores by online logistic context mixing.

A token (a word, or a text's end) is coded as a path of bits: the bits of its hash, as far
as these tell the known words apart. At each branch several predictors, each with the counts
of its own context, give a probability; the contexts are nothing, the group that the
last few frequent words speak for (groups are found from which of these words stand near
each other, and are much like languages), and that group with how the last word ended: plainly, with a full stop, or with
another sign. Their logits are added with
weights chosen by how much the contexts have seen, learned online over all training tokens
while each token's own count is left out, and the sum is refined by an adaptive map.
A word never seen is spelled: its bytes' bits are mixed alike from hashed contexts of one
to six bytes, counted over the known words. Half of the probability of unseen words goes to
their spellings, half evenly to as many words as Chao's estimate expects unseen.

Counts of words grow with the corpus and stay distributed: words are dealt by their hash,
and each part codes its own words. A bounded number of frequent words is scored where the
texts are read; all others by a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import stage, text_or_empty
from tillwise.llm.toxicity import held_out

END = b""
#: Frequent words that tell the group, how many of the last ones do, and groups.
LEADS, REACH, GROUPS = 62, 6, 8
#: Classes of context: group of the last frequent words (or none yet) times how the last word ended.
ENDS = 3
CLASSES = ENDS * (GROUPS + 1)
#: Words scored without a join, at most.
FREQUENT = 1 << 17
#: Parts the words are dealt to, by the top bits of their hash.
PART_BITS = 12
#: Bytes of texts a task reads together.
HELD = 4 << 20
#: Leads whose sums are held together.
LEADS_HELD = 1 << 15
#: (word, class) pairs of a part whose steps are kept in memory.
KEPT = 100_000
#: Bytes of the spelling contexts, and the slots their counts are hashed to.
ORDERS = (1, 2, 3, 4, 6)
SLOTS = (1 << 16, 1 << 18, 1 << 19, 1 << 19, 1 << 19)
LN10 = np.log(10.0)


def digest(word: bytes) -> int:
    """The hash Spark's xxhash64 gives to binary values, unsigned."""
    return xxhash.xxh64_intdigest(word, 42)


#: How a word ends by its last byte. 0: a letter, digit or comma; 1: a full stop; 2: another sign.
ENDING = np.array([1 if b == ord(".") else 0 if b >= 128 or bytes([b]).isalnum() or b == ord(",") else 2
                   for b in range(256)], np.int8)


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``HELD`` bytes, or as they come if larger."""
    held, size = [], 0

    def out():
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
        held.clear()

    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= HELD:
            yield from out()
            size = 0
    if held:
        yield from out()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of UTF-8 texts in order, A-Z in lower case, and how many each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    words, size = split.flatten(), pc.list_value_length(split).to_numpy().astype(np.int64)
    some = pc.greater(pc.binary_length(words), 0)
    if pc.any(pc.invert(some)).as_py():  # white space at either end leaves an empty one
        text = np.repeat(np.arange(len(size)), size)[some.to_numpy(zero_copy_only=False)]
        words, size = words.filter(some), np.bincount(text, minlength=len(size))
    return words.view(pa.binary()), size


def facts(words: pa.Array) -> tuple[np.ndarray, np.ndarray, bytes]:
    """How words end, and the places of their bytes."""
    _, places, data = words.buffers()
    at = np.frombuffer(places, np.int32, len(words) + 1, 4 * words.offset) if len(words) else np.zeros(1, np.int32)
    raw = data.to_pybytes() if data else b""
    last = np.frombuffer(raw + b" ", np.uint8)[at[1:] - 1]
    return np.where(at[1:] > at[:-1], ENDING[last], ENDING[ord(" ")]), at, raw


class Words:
    """Numbers of the words of some texts, with what is known of each; leads and frequent words come first."""

    def __init__(self, leads: dict[bytes, int], speak: np.ndarray, frequent: dict[bytes, int]):
        """``speak``: for each lead, the logarithm of its share in each group."""
        self.speak = speak
        first = list(dict.fromkeys([END, *leads, *frequent]))
        self.first = pa.array(first, pa.binary())
        self.lead = np.array([leads.get(w, -1) for w in first])
        self.frequent = np.array([frequent.get(w, -1) for w in first])
        self.hashed = np.array([digest(w) for w in first], np.uint64)

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, word number, class of context) of every token of the texts."""
        words, sizes = words_of(texts)
        coded = pa.concat_arrays([self.first, words]).dictionary_encode()
        del words
        self.words, self.facts = coded.dictionary, facts(coded.dictionary)
        sizes = sizes + 1
        starts = (np.cumsum(sizes) - sizes).astype(np.int32)
        # Values of all tokens are kept narrow: a task holds several at once.
        text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        ids = np.zeros(len(text), np.int32)  # ends are word 0
        inside = np.ones(len(ids), bool)
        inside[np.cumsum(sizes) - 1] = False
        ids[inside] = coded.indices.to_numpy()[len(self.first):]
        del coded, inside
        number = self.known(self.lead)[ids]
        is_lead = number >= 0
        lead, number = np.flatnonzero(is_lead).astype(np.int32), number[is_lead]
        group = np.full(len(ids), GROUPS, np.int8)
        if len(lead):
            best = self.groups(number, np.searchsorted(lead, starts)[text[lead]])
            last = np.cumsum(is_lead, dtype=np.int32)
            last -= is_lead
            last -= 1  # the last lead before each token
            some = last >= 0
            some &= lead[np.maximum(last, 0)] >= starts[text]
            group[some] = best[last[some]]
        ended = np.ones(len(ids), np.int8)
        ended[1:] = self.facts[0][ids[:-1]]
        ended[starts] = 1
        return text, ids, ENDS * group + ended

    def known(self, of_first: np.ndarray) -> np.ndarray:
        """What is known of the first words, by number; -1 for the others."""
        out = np.full(len(self.words), -1, np.int32)
        out[:len(of_first)] = of_first
        return out

    def groups(self, number: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The group that each lead and those shortly before it, from the text's ``first`` on, speak for."""
        best = np.empty(len(number), np.int8)
        before = np.zeros((1, GROUPS))  # sums up to the last few leads
        for at in range(0, len(number), LEADS_HELD):
            here = np.arange(at, min(at + LEADS_HELD, len(number)))
            since = np.maximum(here + 1 - REACH, first[here])
            sums = np.concatenate([before[:-1], np.cumsum(np.concatenate([before[-1:], self.speak[number[here]]]), axis=0)])
            base = at + 1 - len(before)  # the lead before which the first sum ends
            best[here] = (sums[here + 1 - base] - sums[since - base]).argmax(axis=1)
            before = sums[-REACH:]
        return best

    def hashes(self) -> np.ndarray:
        """Signed hashes of the words by number."""
        _, at, raw = self.facts
        ends = at[len(self.first):].tolist()
        rest = np.array([digest(raw[i:j]) for i, j in zip(ends, ends[1:])], np.uint64)
        return np.concatenate([self.hashed, rest]).view(np.int64)


# -- mixing -----------------------------------------------------------------------------

class Mixer:
    """Weights per gate, learned by damped Newton steps, and the adaptive map behind them."""

    BINS = 33

    def __init__(self, gates: int, start: tuple[float, ...]):
        self.w = np.tile(np.array(start), (gates, 1))
        self.hits = np.zeros(self.BINS)

    def copy(self) -> Mixer:
        """The same weights to go on from; what the map has seen fades to a prior."""
        new = Mixer(1, (0.0,))
        new.w, new.hits = self.w.copy(), self.hits * min(1.0, 500 / max(1.0, self.hits.sum()))
        return new

    def logit(self, gate: np.ndarray, s: np.ndarray) -> np.ndarray:
        z = self.w[gate, 0] * s[:, 0]
        for j in range(1, s.shape[1]):
            z += self.w[gate, j] * s[:, j]
        return np.clip(z, -12, 12)

    def learn(self, gate: np.ndarray, s: np.ndarray, n: np.ndarray, chunks: int = 4) -> None:
        """``s``: logits of what happened, one column per predictor; ``n``: how often."""
        for c in range(min(chunks, len(gate))):
            g, x, m = gate[c::chunks], s[c::chunks], n[c::chunks]
            p = 1 / (1 + np.exp(-self.logit(g, x)))
            rest = m * (1 - p)
            curve = rest * p
            for j in range(x.shape[1]):
                pull = rest * x[:, j]
                up = np.bincount(g, pull, len(self.w))
                down = np.bincount(g, curve * x[:, j] ** 2, len(self.w))
                self.w[:, j] += 0.2 * up / (down + 50.0)
        np.clip(self.w, -0.5, 2.0, out=self.w)

    def watch(self, z: np.ndarray, n: np.ndarray) -> None:
        self.hits += np.bincount(self._bin(z), n, self.BINS)

    def _bin(self, z: np.ndarray) -> np.ndarray:
        return np.rint((np.clip(z, -8, 8) + 8) * (self.BINS - 1) / 16).astype(int)

    def log_p(self, z: np.ndarray) -> np.ndarray:
        """Natural logarithm of the refined probability of what happened."""
        middle = np.linspace(-8, 8, self.BINS)
        prior = 50.0
        own, other = self.hits, self.hits[::-1]  # the other outcome has the opposite logit
        seen = np.log((own + prior / (1 + np.exp(-middle))) / (other + prior / (1 + np.exp(middle))))
        fine = (z + np.interp(z, middle, seen)) / 2
        return -np.logaddexp(0, -fine)


def _fine(seen: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(seen, 0) + 1), 7).astype(np.int8)


def _coarse(seen: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(seen, 0) + 1).astype(np.int8) // 2, 3)


def _gate(own: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return _fine(own).astype(np.int64) * 4 + _coarse(whole)


class Tree:
    """Known words of a part as a binary tree of hashes, with counts per context at each node."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, first_bit: int):
        """``hashes`` ascend; ``counts`` is words by classes."""
        self.hashes, self.first = hashes, first_bit
        zero = np.zeros((1, counts.shape[1]))
        by_class = np.concatenate([zero, np.cumsum(counts, axis=0)])
        by_group = by_class.reshape(len(by_class), -1, ENDS).sum(axis=2)
        self.sums = (by_class, by_group, by_class.sum(axis=1, keepdims=True))

    def branches(self):
        """Per bit: which words are at a branch, their node's range and their side's range."""
        n = len(self.hashes)
        low, high = np.zeros(n, np.int64), np.full(n, n)
        for bit in range(self.first, 64):
            if not (high - low > 1).any():
                return
            one = ((self.hashes >> np.uint64(63 - bit)) & np.uint64(1)).astype(np.int64)
            ones = np.concatenate([[0], np.cumsum(one)])
            middle = high - (ones[high] - ones[low])
            to_low, to_high = np.where(one == 0, low, middle), np.where(one == 0, middle, high)
            yield (middle > low) & (middle < high), low, high, to_low, to_high
            low, high = to_low, to_high

    def steps(self, word: np.ndarray, klass: np.ndarray, less: np.ndarray):
        """Per bit: rows at a branch, their gates and logits; ``less`` is taken off every count."""
        for branch, low, high, to_low, to_high in self.branches():
            rows = np.flatnonzero(branch[word])
            if not len(rows):
                continue
            w, off = word[rows], less[rows]
            logits, seen = [], []
            for sums, col in zip(self.sums, (klass[rows], klass[rows] // ENDS, np.zeros(len(rows), int))):
                node = sums[high[w], col] - sums[low[w], col] - off
                side = sums[to_high[w], col] - sums[to_low[w], col] - off
                logits.append(np.log((side + 0.1) / (node - side + 0.1)))
                seen.append(node)
            yield rows, _gate(seen[0], seen[1]), np.clip(np.column_stack(logits), -12, 12)

    def learn(self, mixer: Mixer, word: np.ndarray, klass: np.ndarray, n: np.ndarray) -> None:
        use = n > 0
        word, klass, n = word[use], klass[use], n[use]
        once = np.ones(len(n))
        # The same steps are walked twice: kept where they are few, else made anew.
        kept = list(self.steps(word, klass, once)) if len(n) <= KEPT else None
        for rows, gate, s in kept or self.steps(word, klass, once):
            mixer.learn(gate, s, n[rows])
        for rows, gate, s in kept or self.steps(word, klass, once):
            mixer.watch(mixer.logit(gate, s), n[rows])

    def log_p(self, mixer: Mixer, word: np.ndarray, klass: np.ndarray) -> np.ndarray:
        out = np.zeros(len(word))
        for rows, gate, s in self.steps(word, klass, np.zeros(len(word))):
            out[rows] += mixer.log_p(mixer.logit(gate, s))
        return out


# -- spelling ---------------------------------------------------------------------------

def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, bit, slots of the contexts) of every bit of the words and their ends."""
    raw = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.int64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(raw)) - np.repeat(np.cumsum(size) - size, size)
    context, before = [], np.zeros(len(raw), np.int64)
    for back in range(1, max(ORDERS) + 1):
        prior = np.zeros(len(raw), np.int64)
        prior[back:] = raw[:-back]
        before = before | np.where(place >= back, prior, 0) << (8 * (back - 1))
        if back in ORDERS:
            context.append(before)
    step = np.arange(8)[:, None]
    node = (1 << step) | (raw >> (8 - step))
    bit = (raw >> (7 - step)) & 1
    slots, base = np.empty((len(SLOTS), 8, len(raw)), np.int64), 0
    for k, (c, many) in enumerate(zip(context, SLOTS)):
        key = c * 256 + node
        slots[k] = base + (_scatter(key, many) if k else key)
        base += many
    return np.tile(word, 8), bit.ravel(), slots.reshape(len(SLOTS), -1).T


def _scatter(key: np.ndarray, many: int) -> np.ndarray:
    mixed = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - (many.bit_length() - 1))).view(np.int64)


class Speller:
    def __init__(self, counts: np.ndarray):
        """``counts``: for every slot, how often its bit was 0 and 1."""
        own = counts.reshape(-1, 2)
        seen = own.sum(axis=1)
        # Logits of a bit and parts of the gate, by how much is taken off: nothing, or the word's own count.
        self.logits = [self._logits(own, less) for less in (0, 1)]
        self.gates = [(_fine(seen - less), _coarse(seen - less)) for less in (0, 1)]

    @staticmethod
    def _logits(own: np.ndarray, less: int) -> np.ndarray:
        taken = np.maximum(own - less, 0)  # a bit never seen is not taken off
        return np.clip(np.log((taken + 0.2) / (own[:, ::-1] + 0.2)), -12, 12).ravel()

    def _step(self, bit, slots, less):
        s = np.empty((slots.shape[1], len(bit)))
        for j in range(len(s)):
            s[j] = self.logits[less][2 * slots[:, j] + bit]
        fine, coarse = self.gates[less]
        return fine[slots[:, 4]].astype(np.int64) * 4 + coarse[slots[:, 2]], s.T

    def learn(self, mixer: Mixer, words: list[bytes]) -> None:
        """From words that the counts hold once each."""
        if words:
            _, bit, slots = spelled(words)
            gate, s = self._step(bit, slots, 1)
            mixer.learn(gate, s, np.ones(len(bit)))
            mixer.watch(mixer.logit(gate, s), np.ones(len(bit)))

    def log_p(self, mixer: Mixer, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        word, bit, slots = spelled(words)
        gate, s = self._step(bit, slots, 0)
        return np.bincount(word, mixer.log_p(mixer.logit(gate, s)), len(words))


# -- passes over the corpus ---------------------------------------------------------------

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the texts to learn from."""
    ends = 0
    for batch in gathered(batches):
        ends += len(batch)
        found = pc.value_counts(words_of(batch.column(0))[0])
        yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["word", "n"])
    if ends:
        yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([ends], pa.int64())], names=["word", "n"])


def _follow(leads: dict[bytes, int]):
    """(lead * LEADS + one of the REACH next leads, n) of the texts to learn from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEADS * LEADS, np.int64)
        known = pa.array(list(leads), pa.binary())
        for batch in batches:
            words, size = words_of(batch.column(0))
            number = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy().astype(np.int64)
            lead = number >= 0
            a, text = number[lead], np.repeat(np.arange(len(size)), size)[lead]
            for lag in range(1, min(REACH, len(a) - 1) + 1):
                both = text[:-lag] == text[lag:]
                total += np.bincount((a[:-lag] * LEADS + a[lag:])[both], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "n"])

    return run


def grouped(follow: np.ndarray) -> np.ndarray:
    """For each lead, the logarithm of its share in each group.

    Leads that stand near the same ones form a group; a group's shares are those of all
    leads near its own, so words of several languages speak for each as they should.
    """
    both = follow + follow.T + 0.0
    rows = np.sqrt(both / np.maximum(both.sum(axis=1, keepdims=True), 1))
    centres = rows[:1]
    often = both.sum(axis=1)
    for _ in range(min(GROUPS, len(rows)) - 1):  # the farthest from those chosen, weighed by how often it stands
        far = (((rows[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1) * often).argmax()
        centres = np.concatenate([centres, rows[far:far + 1]])
    for _ in range(20):
        group = ((rows[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([np.average(rows[group == g], axis=0, weights=often[group == g] + 1e-9)
                            if (group == g).any() else centres[g] for g in range(len(centres))])
    share = np.array([both[group == g].sum(axis=0) if (group == g).any() else np.zeros(len(rows)) for g in range(GROUPS)])
    share = (share + 0.5) / (share + 0.5).sum(axis=1, keepdims=True)
    return np.log(share).T


def _pairs(leads: dict[bytes, int], speak: np.ndarray):
    """(word, class, n) of all texts; n counts only texts to learn from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(leads, speak, {})
        for batch in gathered(batches):
            learn = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            text, ids, klass = words.read(batch.column(0))
            tokens = ids.astype(np.int64)
            tokens *= CLASSES
            tokens += klass
            tokens *= 2
            tokens += learn[text]  # the last bit: learned from
            del text, ids, klass
            tokens.sort()
            pair = tokens >> 1
            first = np.flatnonzero(np.diff(pair, prepend=-1))
            n, pair = np.add.reduceat(tokens & 1, first), pair[first]
            yield pa.RecordBatch.from_arrays(
                [words.words.take(pa.array(pair // CLASSES)), pa.array((pair % CLASSES).astype(np.int16)), pa.array(n)],
                names=["word", "klass", "n"])

    return run


def _spell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(2 * sum(SLOTS), np.int64)
    held: list[bytes] = []

    def add():
        nonlocal total
        if held:
            _, bit, slots = spelled(held)
            base = 0
            for j, many in enumerate(SLOTS):
                total[2 * base:2 * (base + many)] += np.bincount(2 * (slots[:, j] - base) + bit, minlength=2 * many)
                base += many
            held.clear()

    for batch in batches:
        held += batch.column(0).to_pylist()
        if len(held) > 8_000:
            add()
    add()
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])


def _code(shared):
    """Probabilities of the (word, class) pairs of one part."""

    def run(table: pa.Table) -> pa.Table:
        s = shared.value
        words = table["word"].to_pylist()
        klass = table["klass"].to_numpy().astype(np.int64)
        n = table["n"].to_numpy().astype(float)
        part = table["part"][0].as_py()
        names, at = np.unique(np.array([digest(w) for w in words], np.uint64), return_inverse=True)
        count = np.bincount(at, n, len(names))
        known = np.flatnonzero(count > 0)
        place = np.full(len(names), -1)
        place[known] = np.arange(len(known))
        word = place[at]
        out = np.zeros(len(words))
        mine = np.flatnonzero(word >= 0)
        counts = np.zeros((len(known), CLASSES))
        np.add.at(counts, (word[mine], klass[mine]), n[mine])
        tree, mixer = Tree(names[known], counts, PART_BITS), s["mixer"].copy()
        tree.learn(mixer, word[mine], klass[mine], n[mine])
        out[mine] = tree.log_p(mixer, word[mine], klass[mine]) + s["parts"][part, klass[mine]] + np.log1p(-s["fresh"])
        first = np.zeros(len(names), np.int64)
        first[at[::-1]] = np.arange(len(words))[::-1]  # a row of each word
        if "speller" not in s:  # made once by a process, for all its parts
            s["speller"] = Speller(s["spell"])
        speller, smix = s["speller"], Mixer(32, (0.1, 0.1, 0.3, 0.4, 0.4))
        speller.learn(smix, [words[first[i]] for i in np.flatnonzero(count == 1)])
        fresh = np.flatnonzero(count == 0)
        cost = np.zeros(len(names))
        cost[fresh] = speller.log_p(smix, [words[first[i]] for i in fresh])
        theirs = word < 0
        fair = out + 0.0
        fair[theirs] = cost[at[theirs]] + np.log(s["fresh"])
        out[theirs] = np.logaddexp(cost[at[theirs]], -np.log(s["unseen"])) + np.log(s["fresh"] / 2)
        total = count[at]
        return pa.table({
            "word": table["word"], "h": pa.array(names[at].view(np.int64)), "klass": table["klass"],
            "c": pa.array(total.astype(np.int64)), "lp": pa.array(out / LN10), "code": pa.array(fair / LN10),
            "base": pa.array(np.log10((total + 1) / s["base"]))})

    return run


def _score(shared):
    """Per text: sums over frequent words, and what is left to the join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        frequent = {w: i for i, w in enumerate(s["words"])}
        words = Words(s["leads"], s["speak"], frequent)
        lp, base = s["lp"], s["base"]
        rid = TaskContext.get().partitionId() << 40
        for batch in gathered(batches):
            m = len(batch)
            text, ids, klass = words.read(batch.column(2))
            f = words.known(words.frequent)[ids]
            here, there = f >= 0, f < 0
            whose, f = text[here], f[here]
            known = np.bincount(whose, minlength=m)
            sums = [np.bincount(whose, lp[f, klass[here]], m), np.bincount(whose, base[f], m)]
            del whose, f, here
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(text[there], minlength=m))]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (
                words.hashes()[ids[there]], klass[there].astype(np.int16))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid + np.arange(m)), batch.column(0), batch.column(1),
                 pa.array(np.bincount(text, minlength=m)), pa.array(known), pa.array(sums[0]), pa.array(sums[1]),
                 pc.binary_length(batch.column(2)).cast(pa.int64()), *lists],
                names=["rid", "id", "held_out", "n_tokens", "known", "lp", "base", "n_bytes", "hs", "ks"])
            rid += m

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, fold: int = 2) -> DataFrame:
    """Scores of all texts, learning from those outside the held-out fold of the ids.

    Returns id, held_out, n_tokens, n_known, train_tokens, base_score, score (both
    log10) and bits_per_byte (of a code that spells every unseen word). A null or empty text is its end alone. Repeated rows each
    get their own row and each count as training text; null ids are learned from; other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(F.col(id_col).alias("id"), held_out(id_col, folds, fold).alias("held_out"),
                       text_or_empty(text_col).cast("binary").alias("text"))
    train = rows.filter(~F.col("held_out")).select("text")
    counts = stage(train.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")))
    tokens, kinds, once, twice = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count(F.when(F.col("n") == 1, 1)),
        F.count(F.when(F.col("n") == 2, 1))).first()

    top = counts.filter(F.length("word") > 0).orderBy(F.desc("n"), "word").limit(LEADS).collect()
    leads = {bytes(r["word"]): i for i, r in enumerate(top)}
    follow = np.zeros(LEADS * LEADS)
    pairs = train.mapInArrow(_follow(leads), "pair long, n long").groupBy("pair").agg(F.sum("n"))
    for pair, n in pairs.collect():  # LEADS ** 2 rows at most
        follow[pair] = n
    speak = grouped(follow.reshape(LEADS, LEADS))

    part = F.shiftrightunsigned(F.xxhash64("word"), 64 - PART_BITS).cast("int")
    seen = stage(
        rows.select("text", (~F.col("held_out")).cast("double").alias("learn"))
        .mapInArrow(_pairs(leads, speak), "word binary, klass short, n long")
        .groupBy("word", "klass").agg(F.sum("n").alias("n")).withColumn("part", part))

    # The first bits of all codes: a table of fixed size.
    first = np.zeros((1 << PART_BITS, CLASSES))
    for p, k, n in seen.groupBy("part", "klass").agg(F.sum("n")).collect():
        first[p, k] = n
    hashes = np.arange(1 << PART_BITS, dtype=np.uint64) << np.uint64(64 - PART_BITS)
    used = np.flatnonzero(first.sum(axis=1) > 0)
    tree, mixer = Tree(hashes[used], first[used], 0), Mixer(32, (0.5, 0.3, 0.2))
    word, klass = (a.ravel() for a in np.meshgrid(np.arange(len(used)), np.arange(CLASSES), indexing="ij"))
    tree.learn(mixer, word, klass, first[used].ravel())
    parts = np.zeros_like(first)
    if len(used):
        parts[used] = tree.log_p(mixer, word, klass).reshape(len(used), CLASSES)

    spell = np.zeros(2 * sum(SLOTS), np.float32)
    slots = (counts.select("word").mapInArrow(_spell_counts, "slot long, n long")
             .groupBy("slot").agg(F.sum("n").alias("n")).toArrow())  # 2 * sum(SLOTS) rows at most
    spell[slots["slot"].to_numpy()] = slots["n"].to_numpy()

    base = float(tokens + kinds + 1)
    shared = sc.broadcast({"mixer": mixer, "parts": parts, "spell": spell, "base": base,
                           "fresh": (once + 0.5) / (tokens + 1.0),
                           "unseen": max(1.0, once * (once - 1) / (2.0 * (twice + 1)))})
    coded = stage(seen.groupBy("part").applyInArrow(
        _code(shared), "word binary, h long, klass short, c long, lp double, code double, base double"))

    # The least count that leaves at most FREQUENT words above it; one row per distinct count.
    sizes = counts.groupBy("n").count().orderBy(F.desc("n")).limit(FREQUENT).collect()
    least, above = 1 << 62, 0
    for n, many in sizes:
        above += many
        if above > FREQUENT:
            break
        least = n
    often = coded.filter(F.col("c") >= F.lit(least))
    table = often.select("word", "klass", "c", "lp").toArrow()  # FREQUENT * CLASSES rows at most
    names = table["word"].combine_chunks().dictionary_encode()
    lp = np.zeros((max(1, len(names.dictionary)), CLASSES))
    count = np.zeros(len(lp))
    at = names.indices.to_numpy()
    lp[at, table["klass"].to_numpy()] = table["lp"].to_numpy()
    count[at] = table["c"].to_numpy()
    local = sc.broadcast({"words": names.dictionary.to_pylist(), "leads": leads, "speak": speak, "lp": lp,
                          "base": np.log10((count + 1) / base)})
    kind = docs.schema[id_col].dataType.simpleString()
    read = stage(rows.mapInArrow(_score(local), (
        f"rid long, id {kind}, held_out boolean, n_tokens long, known long, lp double, base double, n_bytes long, "
        "hs array<long>, ks array<short>")))
    rest = (
        read.select("rid", F.explode(F.arrays_zip("hs", "ks")).alias("x"))
        .select("rid", F.col("x.hs").alias("h"), F.col("x.ks").alias("klass"))
        .join(coded.filter(F.col("c") < F.lit(least)).select(
            "h", "klass", "c", F.col("lp").alias("l"), F.col("code").alias("f"), F.col("base").alias("b")),
              ["h", "klass"])
        .groupBy("rid").agg(F.sum("l").alias("l"), F.sum("f").alias("f"), F.sum("b").alias("b"),
                            F.sum((F.col("c") > 0).cast("long")).alias("k"))
    )
    total, code = (F.col("lp") + F.coalesce(c, F.lit(0.0)) for c in ("l", "f"))
    return read.drop("hs", "ks").join(rest, "rid", "left").select(
        "id", "held_out", "n_tokens", (F.col("known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", F.lit(0.0))).alias("base_score"), total.alias("score"),
        (-code / F.lit(float(np.log10(2.0))) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"))


def op7(docs: DataFrame) -> DataFrame:
    """The registered report."""
    return score(docs).withColumnRenamed("id", "doc_id")
