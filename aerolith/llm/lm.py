"""Operator 7: language-model scoring by the likelihood of a subword lattice.

A text is its lower-cased words and one end. Each word, with the mark of a word's start before it, is a lattice of all
its segmentations into the pieces of an existing vocabulary; the forward recursion sums them, so the score
is the marginal log10 probability of the text under a unigram model of pieces. Characters that no piece covers are
spelled by the vocabulary's byte pieces, so every text has a probability.

The vocabulary's own scores are where the weights start: they are the negative ranks of a BPE vocabulary, read as
weights 1 / (1 + rank). Expectation steps over all training words (forward and backward, each word's expected pieces
times its count) give the weights that score. Steps end when one has gained less than `LEAST_GAIN` of log10 likelihood a
token, at the latest after `MOST_STEPS`: each reads all distinct words once and none makes the likelihood worse but for
the floor that every piece has.

Beside it stand two more. The base score is an add-one unigram model of whole words. The mixture score adds to the
lattice of a word that the training texts hold one arc from end to end, weighed by its share of all training tokens;
the arcs of pieces together get the share of tokens that were seen once (what Good and Turing expect of unseen ones).

Scale: words are counted in each task, summed by shuffle and written to a table with their count and lattice score, so
each distinct word is scored once. The table is in order of words within its partitions, and words in a row share the
recursions over what they start with. Words above a count that at most `FREQUENT` words reach are broadcast, if they have
at most `MOST_WORD_BYTES` bytes; the others are looked up by a join on the word, which no word dominates, because the
frequent ones are not in it (or are few in a text, being long). What meets in one task is one row for each (document,
rare word) and a sum for each document.

Defined results: a null or empty text is one end. Rows that are equal share one computation and are all returned; null
ids are allowed. With no training documents every count is 0. Texts and words of any length are scored whole. An empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import small_pieces, take_over, written

#: Words that are broadcast, at most.
FREQUENT = 1 << 17
MOST_WORD_BYTES = 64
#: Words that a task counts before it hands them on.
MOST_COUNTED = 300_000
MOST_VOCABULARY = 1 << 20
START = "▁"
LOG10 = math.log(10)
#: Lattices whose probability is above this are summed as plain numbers: what is too small for one adds nothing to it.
LEAST_PLAIN = 1e-200
#: Words of more letters than this share nothing with others: their lattices are not kept.
MOST_SHARED = 128
FLOOR = 0.01  # expected count that every piece has besides
MOST_STEPS = 3
LEAST_GAIN = 0.01


@dataclass
class Pieces:
    """A vocabulary: piece -> number, the numbers of the 256 byte pieces, and the weights it comes with (logs)."""

    number: dict[str, int]
    byte: list[int]
    end: int
    weight: list[float]

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        if n > MOST_VOCABULARY:
            raise ValueError(f"{path} has more than {MOST_VOCABULARY} pieces")
        number, byte = {}, [-1] * 256
        for k in range(n):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                byte[int(piece[1:-1], 16)] = k
            elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
                number[piece] = k
        if min(byte) < 0:
            raise ValueError(f"{path} has no byte pieces")
        raw = [0.0] * n
        for k in [*number.values(), *byte]:
            raw[k] = 1 / (1 + max(0.0, -model.get_score(k)))
        end = model.eos_id()
        for k in byte:
            raw[k] = 1 / n
        raw[end] = 1 / n
        return cls(number, byte, end, _logs(raw))


def _logs(counts: list[float]) -> list[float]:
    total = math.fsum(counts)
    return [math.log(x / total) if x > 0 else -math.inf for x in counts]


class Lattice:
    """Forward and backward recursions over the segmentations of a word."""

    def __init__(self, pieces: Pieces, weight: list[float]):
        self.pieces, self.weight = pieces, weight
        self.log = {piece: weight[k] for piece, k in pieces.number.items()}
        self.starts = {piece[:n] for piece in pieces.number for n in range(1, len(piece) + 1)}
        # what pieces start with, and the pieces with probability and number: one look for both
        self.arc = dict.fromkeys(self.starts) | {piece: (math.exp(weight[k]), k) for piece, k in pieces.number.items()}

    def _spelled(self, c: str) -> list[int]:
        return [self.pieces.byte[b] for b in c.encode("utf-8", "surrogatepass")]

    def forward(self, word: str, edges: list | None = None) -> list[float]:
        """Log probability of each start of the word, all segmentations together; edges gets (from, to, log, piece)."""
        n = len(word)
        alpha = [-math.inf] * (n + 1)
        alpha[0] = 0.0
        starts, log, exp, log1p = self.starts, self.log, math.exp, math.log1p
        for i in range(n):
            a = alpha[i]
            for j in range(i + 1, n + 1):
                part = word[i:j]
                if part not in starts:
                    break
                p = log.get(part)
                if p is not None:
                    if edges is not None:
                        edges.append((i, j, p, part))
                    s, b = a + p, alpha[j]
                    alpha[j] = s if b == -math.inf else b + log1p(exp(s - b)) if s < b else s + log1p(exp(b - s))
            if word[i] not in log:
                p = sum(self.weight[k] for k in self._spelled(word[i]))
                if edges is not None:
                    edges.append((i, i + 1, p, None))
                s, b = a + p, alpha[i + 1]
                alpha[i + 1] = s if b == -math.inf else b + log1p(exp(s - b)) if s < b else s + log1p(exp(b - s))
        return alpha

    def word_log10(self, word: str) -> float:
        plain = self.plain(START + word)
        return math.log10(plain) if plain > LEAST_PLAIN else self.forward(START + word)[-1] / LOG10

    def plain(self, word: str, edges: list | None = None, alpha: list[float] | None = None) -> float:
        """The word's probability, without logs; edges gets (from, to, probability, number of the piece or None)."""
        n = len(word)
        alpha = [] if alpha is None else alpha
        alpha += [0.0] * (n + 1)
        alpha[0] = 1.0
        look = self.arc.get
        for i in range(n):
            a = alpha[i]
            if a == 0.0:  # too small: the logs decide
                return 0.0
            for j in range(i + 1, n + 1):
                found = look(word[i:j], False)
                if found:
                    p, k = found
                    alpha[j] += a * p
                    if edges is not None:
                        edges.append((i, j, p, k))
                elif found is False:
                    break
            if not look(word[i]):
                p = math.exp(sum(self.weight[k] for k in self._spelled(word[i])))
                alpha[i + 1] += a * p
                if edges is not None:
                    edges.append((i, i + 1, p, None))
        return alpha[n]

    def expect(self, word: str, count: int, into: list[float]) -> float:
        """Add the expected number of each piece in `count` such words; their log likelihood."""
        edges: list = []
        alpha: list[float] = []
        marked = START + word
        total = self.plain(marked, edges, alpha)
        if total <= LEAST_PLAIN:
            return self._expect_by_logs(word, count, into)
        beta = [0.0] * len(alpha)
        beta[-1] = count / total
        for i, j, p, k in reversed(edges):
            s = p * beta[j]
            beta[i] += s
            if k is not None:
                into[k] += alpha[i] * s
            else:
                for b in self._spelled(marked[i]):
                    into[b] += alpha[i] * s
        return count * math.log(total)

    def _expect_by_logs(self, word: str, count: int, into: list[float]) -> float:
        edges: list = []
        word = START + word
        alpha = self.forward(word, edges)
        beta = [-math.inf] * (len(word) + 1)
        beta[-1] = 0.0
        total, exp, log1p, number = alpha[-1], math.exp, math.log1p, self.pieces.number
        for i, j, p, part in reversed(edges):  # they were made from the left to the right
            s = p + beta[j]
            share = count * exp(alpha[i] + s - total)
            if part is None:
                for k in self._spelled(word[i]):
                    into[k] += share
            else:
                into[number[part]] += share
            b = beta[i]
            beta[i] = s if b == -math.inf else b + log1p(exp(s - b)) if s < b else s + log1p(exp(b - s))
        return count * total


class Shared:
    """The lattices of words that come in order, as those of one prefix tree: what two words in a row start with is
    worked on once, forward when the first of them comes, backward when the last of them is left. Any order is right, and
    the more two words in a row share, the less is done. Probabilities are plain; the lattice's own recursions do
    what is too small or too long for that."""

    def __init__(self, lattice: Lattice):
        self.lattice, self.into = lattice, [0.0] * len(lattice.weight)
        #: letter -> what follows it, the probability and the number of the piece that ends with it (-1: none does)
        self.root: dict = {}
        for piece, k in lattice.pieces.number.items():
            node = self.root
            for c in piece[:-1]:
                node = node.setdefault(c, [{}, 0.0, -1])[0]
            node.setdefault(piece[-1], [{}, 0.0, -1])[1:] = math.exp(lattice.weight[k]), k
        # for each prefix of the word held: starts of pieces that go on, probability, what is behind it, pieces at its end
        self.held, self.live, self.alpha, self.beta, self.edges = "", [[(0, self.root)]], [1.0], [0.0], [[]]

    def _leave(self, n: int) -> None:
        """Forget all but the first n letters: what words behind them expect is added."""
        alpha, beta, into = self.alpha, self.beta, self.into
        for j in range(len(self.held), n, -1):
            b = beta[j]
            if b:
                for i, p, k in self.edges[j]:
                    s = p * b
                    beta[i] += s
                    if k >= 0:
                        into[k] += alpha[i] * s
                    else:
                        for x in self.lattice._spelled(self.held[j - 1]):
                            into[x] += alpha[i] * s
        for of_prefix in (self.live, alpha, beta, self.edges):
            del of_prefix[n + 1 :]

    def _meet(self, word: str) -> float:
        """The word's probability; the word is held from now on."""
        held, word = self.held, START + word
        n, most = 0, min(len(held), len(word))
        while n < most and held[n] == word[n]:
            n += 1
        self._leave(n)
        self.held, root, live, alpha, edges = word, self.root, self.live, self.alpha, self.edges
        for j in range(n, len(word)):
            c, a, on, ending = word[j], 0.0, [], []
            for i, node in live[j]:
                hit = node.get(c)
                if hit is not None:
                    after, p, k = hit
                    if k >= 0:
                        a += alpha[i] * p
                        ending.append((i, p, k))
                    if after:
                        on.append((i, after))
            if hit is None or hit[2] < 0:  # the last start is the letter's own
                p = math.exp(sum(self.lattice.weight[k] for k in self.lattice._spelled(c)))
                a += alpha[j] * p
                ending.append((j, p, -1))
            on.append((j + 1, root))
            live.append(on)
            alpha.append(a)
            self.beta.append(0.0)
            edges.append(ending)
        return alpha[-1]

    def expect(self, word: str, count: int) -> float:
        """The log likelihood of `count` such words; their pieces are in expected() later."""
        total = self._meet(word) if len(word) <= MOST_SHARED else 0.0
        if total <= LEAST_PLAIN:
            return self.lattice.expect(word, count, self.into)
        self.beta[-1] += count / total
        return count * math.log(total)

    def expected(self) -> list[float]:
        """The expected number of each piece in all words so far."""
        self._leave(0)
        self.held = ""
        return self.into

    def word_log10(self, word: str) -> float:
        total = self._meet(word) if len(word) <= MOST_SHARED else 0.0
        return math.log10(total) if total > LEAST_PLAIN else self.lattice.word_log10(word)


def token_log10(pieces_log10: float, count: int, total: int, unseen: float) -> float:
    """A token's log10 probability: its own arc and the pieces' together."""
    by_pieces = math.log10(unseen) + pieces_log10
    return math.log10((1 - unseen) * count / total + 10**by_pieces) if count and unseen < 1 else by_pieces


def count_words(docs: DataFrame) -> DataFrame:
    """(word, trained, seen) of all words of docs(text, train): counts in training texts and in all texts. Words are in
    order within a partition, so that their lattices share what they start with."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        take_over("lm", dict)
        seen: list[Counter] = [Counter(), Counter()]

        def out() -> Iterator[pa.RecordBatch]:
            for k in (0, 1):
                if seen[k]:
                    n = pa.array(list(seen[k].values()), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(list(seen[k]), pa.binary()).cast(pa.string()), n if k else pa.nulls(len(n), pa.int64()).fill_null(0), n], ["word", "trained", "seen"])
                    seen[k].clear()

        for batch in small_pieces(batches):
            for text, train in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("train").to_pylist(), strict=True):
                seen[train].update((text or b"").lower().split())
            if len(seen[0]) + len(seen[1]) > MOST_COUNTED:
                yield from out()
        yield from out()

    parts = docs.mapInArrow(counted, "word string, trained long, seen long")
    return parts.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("seen").alias("seen")).sortWithinPartitions("word")


def learn_pieces(words: DataFrame, pieces: Pieces, n_docs: int, tokens: int, most_steps: int = MOST_STEPS, least_gain: float = LEAST_GAIN) -> list[float]:
    """Logs of the pieces' probabilities: expectation steps over the training words, and an end for each document. tokens
    is the number of all training tokens."""
    shared = words.sparkSession.sparkContext.broadcast(pieces)
    trained = words.where("trained > 0").select("word", "trained")
    weight, before = pieces.weight, -math.inf
    for _ in range(most_steps):
        now = words.sparkSession.sparkContext.broadcast(weight)

        def expected(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            lattices, likely = Shared(Lattice(shared.value, now.value)), []
            for batch in batches:
                for word, n in zip(batch.column("word").to_pylist(), batch.column("trained").to_pylist(), strict=True):
                    likely.append(lattices.expect(word, n))
                likely = [math.fsum(likely)]
            into = lattices.expected()
            found = [k for k, x in enumerate(into) if x]
            yield pa.RecordBatch.from_arrays([pa.array([-1, *found], pa.int32()), pa.array([math.fsum(likely), *(into[k] for k in found)], pa.float64())], ["piece", "n"])

        # as many rows as the vocabulary has pieces, at most, and one of the likelihood
        sums = {r.piece: r.n for r in trained.mapInArrow(expected, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()}
        likely = sums.pop(-1, 0.0) + n_docs * weight[pieces.end]
        counts = [0.0] * len(weight)
        for k in [*pieces.number.values(), *pieces.byte]:
            counts[k] = FLOOR
        for k, n in sums.items():
            counts[k] += n
        counts[pieces.end] = n_docs + FLOOR
        weight = _logs(counts)
        now.unpersist()
        if likely - before < least_gain * LOG10 * tokens:
            break
        before = likely
    return weight


def score(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text", train: str = "train", frequent: int = FREQUENT, most_steps: int = MOST_STEPS, least_gain: float = LEAST_GAIN) -> DataFrame:
    """One row for each row of docs: id, train, n_tokens, n_known, train_tokens, base_score, score, mixture_score (log10).

    train is a boolean column: the model learns from these rows."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{train}`"), F.lit(False)).alias("train"))
    words = written(count_words(rows.select("text", "train")), "lm-counts")
    n_docs = rows.where("train").count()
    total, distinct, once = words.agg(F.coalesce(F.sum("trained"), F.lit(0)), F.count_if(F.col("trained") > 0), F.count_if(F.col("trained") == 1)).first()
    total, distinct = total + n_docs, distinct + (n_docs > 0)
    unseen = (once + 1) / (total + 1)

    pieces = Pieces.load(vocabulary)
    model = spark.sparkContext.broadcast((pieces, learn_pieces(words, pieces, n_docs, total, most_steps, least_gain)))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Shared(Lattice(*model.value))
        for batch in batches:
            logs = [lattices.word_log10(x) for x in batch.column("word").to_pylist()]
            mixed = [token_log10(p, c, total, unseen) for p, c in zip(logs, batch.column("trained").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs, pa.float64()), pa.array(mixed, pa.float64())], ["word", "trained", "seen", "log10", "mixed"])

    words = written(words.mapInArrow(scored, "word string, trained long, seen long, log10 double, mixed double"), "lm-words")

    # the lowest count that at most `frequent` words reach, from how many words have each count
    levels = words.groupBy(F.least("seen", F.lit(1 << 20)).alias("seen")).agg(F.count("*").alias("n")).orderBy(F.desc("seen"))
    least, held = (1 << 20) + 1, 0
    for r in levels.toLocalIterator():
        if held + r.n > frequent:
            break
        held, least = held + r.n, r.seen
    often = (F.col("seen") >= least) & (F.octet_length("word") <= MOST_WORD_BYTES)
    common = words.where(often).select("word", "trained", "log10", "mixed").toArrow()
    end = model.value[1][pieces.end] / LOG10
    ends = end, token_log10(end, n_docs, total, unseen)
    table = spark.sparkContext.broadcast(({w.encode(): rest for w, *rest in zip(*(common.column(k).to_pylist() for k in range(4)), strict=True)}, total, distinct, n_docs, ends))

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from collections import Counter

        found, total, distinct, n_docs, ends = table.value
        whole = math.log10(total + distinct + 1)
        known = {word: (math.log10(c + 1), p, m, c > 0) for word, (c, p, m) in found.items()}
        names = ["id", "tie", "train", "word", "n", "n_tokens", "n_known", "base", "log", "mixed"]
        for batch in small_pieces(batches):
            out: list[list] = [[] for _ in names]
            for at, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                counts = Counter(text.lower().split())
                base, n_known, n_tokens = math.log10(n_docs + 1), int(n_docs > 0), 1
                log, mixed = ends
                rare = []
                for word, n in counts.items():
                    n_tokens += n
                    hit = known.get(word)
                    if hit is None:
                        rare.append((word, n))
                    else:
                        base += n * hit[0]
                        log += n * hit[1]
                        mixed += n * hit[2]
                        n_known += n * hit[3]
                # a row for the document, under a word that no text has, and one for each rare word
                for row in ((at, b" %d" % at, 0, n_tokens, n_known, base - n_tokens * whole, log, mixed), *((at, word, n, None, None, None, None, None) for word, n in rare)):
                    for column, x in zip((out[0], *out[3:]), row, strict=True):
                        column.append(x)
            at = pa.array(out[0], pa.int64())
            own = [batch.column(k).take(at) for k in ("id", "tie", "train")]
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            rest = [pa.array(x, kind) for x, kind in zip(out[3:], kinds, strict=True)]
            rest[0] = rest[0].cast(pa.string())
            yield pa.RecordBatch.from_arrays([*own, *rest], names)

    kind = rows.schema["id"].dataType.simpleString()
    parts = rows.select("id", "text", "train", F.xxhash64("text").alias("tie")).mapInArrow(looked_up, f"id {kind}, tie long, train boolean, word string, n long, n_tokens long, n_known long, base double, log double, mixed double")
    side = words.where(~often).select(F.col("word").alias("w"), F.col("trained").alias("c"), F.col("log10").alias("l"), F.col("mixed").alias("m"))
    met = parts.join(side, F.col("word") == F.col("w"), "left")
    n, zero = F.col("n"), F.lit(0.0)
    sums = met.groupBy("id", "tie", "train").agg(
        F.count("n_tokens").alias("copies"),
        F.max("n_tokens").alias("n_tokens"),
        F.max("n_known").alias("own_known"),
        F.max("base").alias("own_base"),
        F.max("log").alias("own_log"),
        F.max("mixed").alias("own_mixed"),
        F.coalesce(F.sum(F.when(F.col("c") > 0, n)), F.lit(0)).alias("more_known"),
        F.coalesce(F.sum(n * F.log10(F.col("c") + 1)), zero).alias("more_base"),
        F.coalesce(F.sum(n * F.col("l")), zero).alias("more_log"),
        F.coalesce(F.sum(n * F.col("m")), zero).alias("more_mixed"),
    )
    # equal rows were added up; each is returned
    each = sums.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    whole = lambda own, more: F.col(own) + F.col(more) / F.col("copies")
    return each.select(
        "id", "train", "n_tokens", (F.col("own_known") + F.expr("more_known div copies")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        whole("own_base", "more_base").alias("base_score"), whole("own_log", "more_log").alias("score"), whole("own_mixed", "more_mixed").alias("mixture_score"),
    )
