"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

A tokenizer's vocabulary covers what people write, so that words and code give many characters a token and random
strings few. Runs of `LEAST_RUN` and more key-like characters that give few characters a token are reported as `random`,
unless they are known (a labelled checksum, a UUID, a digest of the empty text, a key printed as an example in public
manuals, a digest on the caller's list) or an identifier (mostly words and numbers between separators, a date or number).
The most characters a token may give is lower for small letters alone, since these may be words of a language that the
vocabulary covers badly, and higher where digits stand among letters. Spans of the base patterns always stay.

Defined results: null counts as empty and gives no span; offsets are code points, ends exclusive; overlapping spans of
different kinds are all reported; very long texts are scanned whole. Extra columns are ignored by `scan` and kept by
`redacted`.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.llm.common import in_small_batches, pruned, tidy

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pre-tokenisation pattern that belongs to the vocabulary (fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
#: A cheap look-ahead: where no run of 32 hex digits starts at all, the hex scan is skipped.
_HEX_RUN = re.compile(r"[0-9a-f]{32}")
#: Least length of a random string, and the most characters a token it may give: of small letters, of any letters, with digits.
LEAST_RUN = 16
MAX_CHARS_PER_TOKEN = (1.7, 1.9, 2.2)
WORD_CHARS_PER_TOKEN = 2.5
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_RUN)
_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_NUMBER = re.compile(r"[0-9]+(?:[-_T+/=][0-9]+)*Z?=*")
#: Words of five letters and more (a capital begins one), and numbers between separators.
_WORDS = re.compile(r"[A-Z]?[a-z]{4,}|[A-Z]{5,}(?![a-z])|(?<![A-Za-z0-9])[0-9]+(?![A-Za-z0-9])")
_SMALL = re.compile(r"[A-Z]?[a-z+/_=-]+")
_LETTERS = re.compile(r"[A-Za-z+/_=-]+")
_LABEL = re.compile(r"(?ai:(?:sha-?(?:1|224|256|384|512)|md5|crc32|digest|checksum|integrity|etag|commit|revision))[\"']?\x20*[:=-]?\x20*[\"']?$")
#: Keys that public manuals print as examples. With the digests of the empty text they are never secrets.
EXAMPLES = ("wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "je7MtGbClwBF/2Zp9Utk/h3yCo8nvbEXAMPLEKEY", "eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9", "4eC39HqLyjWDarjtT1zdp7dc")
_ROW = "0123456789abcdefghijklmnopqrstuvwxyz"
ROWS = f"{_ROW}{_ROW[10:]}{_ROW[10:]}{_ROW[:10]}+/-_"  # characters in their order, as alphabets are written
KNOWN = frozenset(x.lower() for x in EXAMPLES) | {getattr(hashlib, name)(b"").hexdigest() for name in ("md5", "sha1", "sha224", "sha256", "sha384", "sha512")}


@lru_cache(maxsize=4)
def encoder(lines: bytes):
    """tiktoken encoding from the lines of a vocabulary file (base64 token, rank)."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary(spark: SparkSession, path: str):
    """Broadcast of a vocabulary file that the driver reads (about a megabyte, whatever the input)."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns."""
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if _HEX_RUN.search(text):
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= 32]
    return found


def identifier(run: str, encode) -> bool:
    """Whether the run is a UUID, a number or date, a row of the alphabet, or mostly numbers between separators and words, which
    take few tokens."""
    if _UUID.fullmatch(run) or _NUMBER.fullmatch(run):
        return True
    if run.lower() in ROWS:
        return True
    if _SMALL.fullmatch(run):
        return False  # only the tokens tell words from noise here
    words = sum(len(w) for w in _WORDS.findall(run) if w[0].isdigit() or len(w) >= WORD_CHARS_PER_TOKEN * len(encode(w)))
    return words >= 0.7 * sum(c.isalnum() for c in run)


def random_spans(text: str, encode, known: frozenset[str] = KNOWN, most: tuple[float, float, float] = MAX_CHARS_PER_TOKEN) -> list[tuple[int, int, int]]:
    found = []
    for m in _RUN.finditer(text):
        run = m[0]
        kind = 0 if _SMALL.fullmatch(run) else 1 if _LETTERS.fullmatch(run) else 2
        if len(run) >= most[kind] * len(encode(run)) or identifier(run, encode):
            continue
        if run.lower().rstrip("=") in known or run.lower() in known or hashlib.sha256(run.encode()).hexdigest() in known or _LABEL.search(text, max(0, m.start() - 24), m.start()):
            continue
        found.append((m.start(), 3, m.end()))
    return found


def _shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan_text(text: str, encode, known: frozenset[str] = KNOWN, most: tuple[float, float, float] = MAX_CHARS_PER_TOKEN) -> tuple[list, list]:
    """Base spans and all spans. A random run inside a base span adds nothing."""
    base = base_spans(text)
    extra = [x for x in random_spans(text, encode, known, most) if not any(a <= x[0] and x[2] <= b for a, _, b in base)]
    return base, base + extra


_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"


def scan(docs: DataFrame, vocabulary_path: str = VOCABULARY, known_digests: tuple[str, ...] = (), most: tuple[float, float, float] = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """A row of counts and spans for each row of docs. known_digests: strings (or their SHA-256) that are no secrets, beside KNOWN."""
    words = vocabulary(docs.sparkSession, vocabulary_path)
    known = KNOWN | {x.lower() for x in known_digests}

    @tidy
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(words.value).encode_ordinary
        for batch in batches:
            counts, digests, shown = [[], [], [], []], [], []
            for text in batch.column(1):
                base, spans = scan_text(text.as_py() or "", encode, known, most)
                for k in range(4):
                    counts[k].append(sum(s[1] == k for s in spans))
                digests.append(hashlib.sha256(_shown(base).encode()).hexdigest())
                shown.append(_shown(spans))
            a, b, c, d = (pa.array(x, pa.int64()) for x in counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), a, b, c, pa.array(digests, pa.string()), pa.array(shown, pa.string()), d], names=[x.split()[0] for x in _SCHEMA.split(", ")])

    return pruned(docs).mapInArrow(found, _SCHEMA)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """text with every maximal run of overlapping spans replaced by the mark."""
    out, at = [], 0
    for a, _, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, vocabulary_path: str = VOCABULARY, mark: str = "[SECRET]", text: str = "text", n_chars: str = "n_chars", known_digests: tuple[str, ...] = ()) -> DataFrame:
    """docs with each secret replaced by a mark and n_chars brought up to date; no row goes, none moves."""
    words = vocabulary(docs.sparkSession, vocabulary_path)
    known = KNOWN | {x.lower() for x in known_digests}

    @tidy
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode = encoder(words.value).encode_ordinary
        for texts in batches:
            yield pa.array([t if t is None or not (spans := scan_text(t, encode, known)[1]) else redact(t, spans, mark) for t in texts.to_pylist()], pa.string())

    out = in_small_batches(docs).withColumn(text, F.arrow_udf(clean, "string")(docs[text].cast("string")))
    return out.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType)) if n_chars in docs.columns else out
