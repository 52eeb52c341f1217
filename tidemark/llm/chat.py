"""Chat formatting on token ids: encode the segments apart, splice reserved ids, mask by prefix sums of lengths.

Control strings have ids of their own above the vocabulary, and texts are encoded without special tokens, so no text
can forge a turn. Inside texts control strings are broken up by an escape, so that the rendered string holds only the
template's own, even for a tokenizer that turns control strings into reserved ids.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The template's control strings. A turn of role user is [INST] text [/INST], an assistant's text ends
#: with </s>, any other role is [ROLE] name [/ROLE] text [/TURN].
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[ASST]", "[/TURN]")
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the byte-pair split pattern that the vocabulary was made with.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The split pattern can't match runs of white space of a million characters, so longer ones are cut out beforehand.
_LONG_BLANK = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{100000,}")
_ESCAPED = re.compile("|".join(re.escape(x) for x in ("\\", *CONTROL)))
_UNESCAPE = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """A backslash is doubled; a control string gets one after its first character, which breaks it up.

    Control strings start with a character that none has further on, so they never overlap and no new one can arise.
    """
    return _ESCAPED.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


class Codec:
    def __init__(self, vocabulary: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.plain = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.first = max(ranks.values()) + 1
        self.ids = {c: self.first + i for i, c in enumerate(CONTROL)}

    def encode(self, text: str) -> list[int]:
        """The ids of text. No piece of the split pattern begins before a run of white space and ends in it, and of a run
        followed by other text all but its last character are a piece: there the text may be cut, with the same ids."""
        out, at = [], 0
        for run in _LONG_BLANK.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += self.plain.encode_ordinary(text[at : run.start()])
            out += self._blank(text[run.start() : end])
            at = end
        return out + self.plain.encode_ordinary(text[at:])

    def _blank(self, run: str) -> list[int]:
        """The ids of one long piece of white space, which pair merging alone would take very long for."""
        return self.plain._encode_single_piece(run)

    def decode(self, ids: list[int]) -> str:
        """Text of a segment without reserved ids."""
        return self.plain.decode_bytes(ids).decode()

    def render(self, ids: np.ndarray) -> str:
        """The formatted string of a whole sequence, control strings included."""
        return "".join(CONTROL[s[0] - self.first] if s[0] >= self.first else self.decode(s) for s in self.segments(ids))

    def segments(self, ids: np.ndarray) -> Iterator[list[int]]:
        """Reserved ids one by one, and the runs of ordinary ids between them."""
        marks = np.flatnonzero(ids >= self.first)
        at = 0
        for m in marks:
            if m > at:
                yield ids[at:m].tolist()
            yield [int(ids[m])]
            at = m + 1
        if at < len(ids):
            yield ids[at:].tolist()


def read_vocabulary(spark: SparkSession, path: str = VOCABULARY) -> bytes:
    """The vocabulary file: a path of the driver's own, or a URL that Spark reads. It is broadcast, so 64 MB are the most."""
    if "://" in path:
        found = spark.read.format("binaryFile").load(path).where(F.col("length") <= 64 << 20).select("content").first()
        content = bytes(found["content"]) if found else None
    else:
        with open(path, "rb") as f:
            content = f.read((64 << 20) + 1)
    if content is None or len(content) > 64 << 20:
        raise ValueError(f"no vocabulary of at most 64 MB at {path}")
    return content


@lru_cache(2)
def codec(vocabulary: bytes) -> Codec:
    """One codec per process and vocabulary."""
    return Codec(vocabulary)


def format_turn(c: Codec, role: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, loss mask) of one turn: the mask covers an assistant's text tokens and nothing else."""
    body = c.encode(escape(text))
    if role == "user":
        parts = [([c.ids["[INST]"]], 0), (body, 0), ([c.ids["[/INST]"]], 0)]
    elif role == "assistant":
        parts = [([c.ids["[ASST]"]], 0), (body, 1), ([c.ids["</s>"]], 0)]
    else:
        parts = [([c.ids["[ROLE]"]], 0), (c.encode(escape(role)), 0), ([c.ids["[/ROLE]"]], 0), (body, 0), ([c.ids["[/TURN]"]], 0)]
    ends = np.cumsum([len(ids) for ids, _ in parts])
    step = np.zeros(int(ends[-1]) + 1, np.int32)
    for end, (ids, loss) in zip(ends, parts, strict=True):
        step[end - len(ids)] += loss
        step[end] -= loss
    return np.concatenate([np.asarray(ids, np.int32) for ids, _ in parts]), np.cumsum(step[:-1]).astype(np.uint8)


def parse(c: Codec, ids: np.ndarray) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted sequence."""
    role, text, in_name, name = "", "", False, {c.ids[k]: k for k in CONTROL}
    for segment in c.segments(ids):
        mark = name.get(segment[0])
        if mark is None:
            if in_name:
                role = unescape(c.decode(segment))
            else:
                text = unescape(c.decode(segment))
        elif mark == "[ROLE]":
            role, text, in_name = "", "", True
        elif mark == "[/ROLE]":
            in_name = False
        elif mark in ("[INST]", "[ASST]"):
            role, text = ("user" if mark == "[INST]" else "assistant"), ""
        elif mark != "<s>":
            yield role, text


def format_turns(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Rows (conv_id, turn, role, text) to conv_id, turn, input_ids, loss_mask, one row per turn.

    Null text and null role are empty strings. Map-only: a conversation of any length is spread over the tasks, and its
    formatted sequence is <s> and then its turns' ids in order of turn (see conversations()). A text is encoded whole,
    however long. The file at vocabulary is read once and broadcast.
    """
    shared = turns.sparkSession.sparkContext.broadcast(read_vocabulary(turns.sparkSession, vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                made = [format_turn(c, r or "", t or "") for r, t in zip(part.column("role").to_pylist(), part.column("text").to_pylist(), strict=True)]
                off = pa.array(np.concatenate([[0], np.cumsum([len(a) for a, _ in made])]).astype(np.int32))
                ids = pa.ListArray.from_arrays(off, pa.array(np.concatenate([a for a, _ in made])))
                mask = pa.array([m.tobytes() for _, m in made], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("conv_id"), part.column("turn"), ids, mask], ["conv_id", "turn", "input_ids", "loss_mask"])

    types = dict(turns.dtypes)
    return turns.select("conv_id", "turn", "role", "text").mapInArrow(run, f"conv_id {types['conv_id']}, turn {types['turn']}, input_ids array<int>, loss_mask binary")


def _stream(formatted: DataFrame, make, schema: str) -> DataFrame:
    """Feed each conversation's turns, in order, to make(codec-less) accumulators; memory is one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done, some = None, None, [], False
        for batch in batches:
            convs, ids, masks = batch.column("conv_id"), batch.column("input_ids"), batch.column("loss_mask")
            for i in range(batch.num_rows):
                conv = convs[i].as_py()
                if not some or conv != key:
                    if some:
                        done.append((key, *state.close()))
                    key, state, some = conv, make(), True
                state.add(ids[i].values.to_numpy(), np.frombuffer(masks[i].as_buffer(), np.uint8))
            if len(done) > 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, d, strict=True)) for d in done])
                done = []
        if some:
            done.append((key, *state.close()))
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(names, d, strict=True)) for d in done])

    names = [x.split()[0] for x in schema.split(", ")]
    return formatted.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "input_ids").mapInArrow(run, schema)


class _Digest:
    """Reads formatted turns back: digests of turns and of the text under the loss mask, kept as running states."""

    def __init__(self, c: Codec):
        self.c, self.n, self.loss_chars = c, 0, 0
        self.chars = len(c.render(np.array([c.ids["<s>"]])))  # a conversation begins with it
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, ids: np.ndarray, mask: np.ndarray) -> None:
        self.chars += len(self.c.render(ids))
        for role, text in parse(self.c, ids):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        under = ids[mask.astype(bool)]
        if len(under):
            text = unescape(self.c.decode(under.tolist()))
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def close(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def read_back(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per conversation, from the formatted ids alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    One shuffle by conv_id. A conversation's turns stream through one task in order, as its digests demand; the task
    keeps only running states, so a conversation that holds a third of all rows needs no more memory than any other.
    Turns with equal numbers are ordered by their ids; null conv_id is a conversation of its own. formatted_chars is the
    length of the whole conversation as rendered: what conversations() gives, from its <s> on.
    """
    kind = dict(formatted.dtypes)["conv_id"]
    shared = formatted.sparkSession.sparkContext.broadcast(read_vocabulary(formatted.sparkSession, vocabulary))
    return _stream(formatted, lambda: _Digest(codec(shared.value)), f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def conversations(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Training rows: conv_id, input_ids (with the leading <s>), loss_mask. A row holds a whole conversation."""
    start = codec(read_vocabulary(formatted.sparkSession, vocabulary)).ids["<s>"]
    turns = F.sort_array(F.collect_list(F.struct("turn", "input_ids", F.hex("loss_mask").alias("mask"))))
    return formatted.groupBy("conv_id").agg(turns.alias("t")).select(
        "conv_id",
        F.concat(F.array(F.lit(start)), F.flatten(F.transform("t", lambda x: x["input_ids"]))).alias("input_ids"),
        F.unhex(F.concat(F.lit("00"), F.array_join(F.transform("t", lambda x: x["mask"]), ""))).alias("loss_mask"),
    )
