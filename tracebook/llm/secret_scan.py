"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

A candidate is a long unbroken token with a digit or mixed case, or what is assigned to a name
that sounds like a credential. The forest looks at its length, at the transitions between its
characters, at how much of it a dictionary covers, at path-like surroundings and at the words
next to it. It is trained on labelled findings: a table of texts with spans and labels. Where
none is at hand, ``fitted`` makes one: the candidates of all documents that the naming rule below
decides, and formats of known credentials and known look-alikes, drawn by rule.

The dictionary is counted over all documents. It and the forest are of bounded size and travel
with the tasks; texts are scanned whole and neither shuffled nor gathered.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracebook.llm.common import byte_texts, chunks, stored
from tracebook.llm.forests import UNIT, grown
from tracebook.llm.trees import Node, forest_values

# Names that credentials are assigned to, and names of look-alikes.
KEY_NAMES = ("token", "secret", "password", "passwd", "pwd", "apikey", "api", "key", "auth", "bearer", "credential",
             "private", "access")
OTHER_NAMES = ("commit", "sha", "sha1", "sha256", "md5", "hash", "checksum", "digest", "uuid", "guid", "id", "version",
               "revision", "example", "sample", "test", "dummy", "placeholder", "image", "phone", "isbn")

LONG = re.compile(rb"[A-Za-z0-9+/_=.\-]{16,}")
ASSIGNED = re.compile(
    rb"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|credential)s?[\"']?\s{0,3}(?:[=:]|=>)\s{0,3}"
    rb"(?:[\"'`]([^\s\"'`]{6,})[\"'`]|([^\s\"'`,;&()<>\[\]{}]{6,}))"
)
# a word before a candidate that says what it is: assigned or just named
NAMED = re.compile(rb"([a-z0-9_\-]+)[\"']?\s*(?:[=:#]+|=>)?\s*[\"'`]?$")
AROUND = 48
DICTIONARY_WORDS = 20_000
WORDS_COUNTED_AT_ONCE = 200_000
WORDS_PER_PARTITION = 5_000_000
MASKED = b"[secret removed]"


def candidates(text: bytes) -> list[tuple[int, int]]:
    """(start, end) byte spans of candidates, in order, none inside another."""
    found = {}
    for match in LONG.finditer(text):
        token = match.group()
        start = match.start() + len(token) - len(token.lstrip(b"=.-"))
        end = match.end() - (len(token) - len(token.rstrip(b".-")))
        token = text[start:end]
        mixed = token != token.lower() and token != token.upper() and token[1:] != token[1:].lower()
        if end - start >= 16 and (mixed or any(48 <= b <= 57 for b in token)) and not token.translate(None, b".-0123456789") == b"":
            found[start] = end
    if b"=" in text or b":" in text:
        for match in ASSIGNED.finditer(text):
            start, end = match.span(1 if match.group(1) else 2)
            found = {s: e for s, e in found.items() if e <= start or s >= end}
            found[start] = end
    return sorted(found.items())


def char_class(byte: int) -> int:
    return 0 if 97 <= byte <= 122 else 1 if 65 <= byte <= 90 else 2 if 48 <= byte <= 57 else 3


@dataclass
class Surroundings:
    """What the features are measured against: a dictionary and its letter pairs."""

    words: frozenset[bytes]
    pairs: dict[bytes, float]

    def covered(self, token: bytes) -> float:
        """Share of the token in dictionary words of four letters or more, longest first."""
        low, at, inside = token.lower(), 0, 0
        while at < len(low):
            step = next((n for n in range(min(12, len(low) - at), 3, -1) if low[at : at + n] in self.words), 0)
            inside += step
            at += step or 1
        return inside / max(len(low), 1)

    def pair_score(self, token: bytes) -> float:
        low = token.lower()
        scores = [self.pairs.get(low[i : i + 2], -8.0) for i in range(len(low) - 1)]
        return sum(scores) / len(scores) if scores else -8.0


# ASCII letters lower-cased, bytes of other characters kept, all else a space
LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def _counted(counts: Counter[bytes]) -> pa.RecordBatch:
    kept = [(word, n) for word, n in counts.items() if len(word) >= 3]
    words, numbers = zip(*kept, strict=True) if kept else ([], [])
    return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(numbers, pa.int64())], names=["word", "n"])


def _words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()
    for batch in batches:
        for _, run in chunks(byte_texts(batch)):
            counts.update(b" ".join(run).translate(LETTERS).split())
            if len(counts) > WORDS_COUNTED_AT_ONCE:
                yield _counted(counts)
                counts.clear()
    yield _counted(counts)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): runs of three bytes or more of letters, ASCII lower-cased, in all texts."""
    counted = docs.select("text").mapInArrow(_words, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def dictionary(counts: DataFrame, most: int = DICTIONARY_WORDS) -> tuple[Surroundings, int]:
    """The most frequent words and how likely their letter pairs are; also how many words were counted.

    At most ``most`` words; of words that are equally frequent all are in or none.
    """
    inside, total, least = 0, 0, 1
    # one row per distinct count: their number grows with the root of the number of words
    for n, words in sorted(((r.n, r.words) for r in counts.groupBy("n").agg(F.count("*").alias("words")).collect()), reverse=True):
        total += n * words
        inside += words
        if inside > most and least == 1:
            least = n + 1
    common = [bytes(r.word) for r in counts.where(F.col("n") >= least).select("word").collect()]
    pairs = Counter(w[i : i + 2] for w in common for i in range(len(w) - 1))
    sums = sum(pairs.values()) or 1
    return Surroundings(frozenset(common), {p: math.log(n / sums) for p, n in pairs.items()}), total


def features(text: bytes, start: int, end: int, around: Surroundings, path: str = "") -> list[float]:
    token = text[start:end]
    size = max(len(token), 1)
    kinds = [char_class(b) for b in token]
    counts = Counter(token)
    entropy = -sum(n / size * math.log2(n / size) for n in counts.values())
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    runs = max((len(m) for m in re.findall(rb"[A-Za-z]+", token)), default=0)
    steps = Counter(b - a for a, b in zip(token, token[1:], strict=False))
    before = re.findall(rb"[a-z0-9]+", text[max(0, start - AROUND) : start].lower())[-3:]
    after = re.findall(rb"[a-z0-9]+", text[end : end + AROUND].lower())[:2]
    near = [w.decode() for w in before + after]
    lead = text[max(0, start - 6) : start].strip()
    low = token.lower()
    return [
        size,
        len(counts) / size,
        entropy,
        *[kinds.count(k) / size for k in range(4)],
        changes / size,
        runs,
        max(steps.values(), default=0) / size,
        float(all(c in b"0123456789abcdef" for c in low)),
        around.pair_score(token),
        around.covered(token),
        float(token.count(b"/") + token.count(b".")),
        float(lead.endswith((b"/", b"\\", b"."))),
        float(b"http" in text[max(0, start - AROUND) : end].lower() or b"www." in text[max(0, start - AROUND) : end]),
        float(any(name in path.lower() for name in ("test", "example", "doc", "lock"))),
        float(lead.endswith((b'"', b"'", b"`")) and text[end : end + 1] in (b'"', b"'", b"`")),
        float(b"=" in lead or b":" in lead),
        float(any(w in KEY_NAMES for w in near)),
        float(bool(before) and before[-1].decode() in KEY_NAMES),
        float(any(w in OTHER_NAMES for w in near)),
        float(any(x in low for x in (b"xxxx", b"example", b"your", b"0000", b"1234", b"changeme", b"placeholder"))),
        float(low.startswith((b"akia", b"ghp_", b"gho_", b"sk_live", b"sk-", b"xox", b"eyj", b"glpat"))),
    ]


def generated_findings(n: int = 600, seed: int = 17) -> list[tuple[bytes, int, int, int]]:
    """(text, start, end, label) drawn by rule: known credential formats, and known look-alikes."""
    rng = random.Random(seed)
    hexes, b64 = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def draw(letters: str, size: int) -> str:
        return "".join(rng.choice(letters) for _ in range(size))

    def uuid() -> str:
        return "-".join(draw(hexes, k) for k in (8, 4, 4, 4, 12))

    # formats that name themselves, and values that only their place gives away
    marked = [
        lambda: "AKIA" + draw(b64[:26] + b64[52:], 16),
        lambda: "ghp_" + draw(b64, 36),
        lambda: "sk_live_" + draw(b64, 24),
        lambda: "glpat-" + draw(b64, 20),
        lambda: "xoxb-" + draw("0123456789", 12) + "-" + draw(b64, 24),
        lambda: "eyJ" + draw(b64, 24) + "." + draw(b64, 40) + "." + draw(b64 + "_-", 43),
    ]
    unmarked = [
        lambda: draw(b64 + "+/", 40),
        lambda: draw(hexes, rng.choice([32, 40, 64])),
        lambda: draw(b64 + "!#%*", rng.randrange(8, 20)) + draw("0123456789", 1),
    ]
    other = [
        uuid,
        lambda: draw(hexes, rng.choice([32, 40, 64])),
        lambda: "your_" + rng.choice(["api", "secret", "access"]) + "_key_1234",
        lambda: "x" * rng.randrange(16, 40) + "1",
        lambda: "/".join(rng.choice(["usr", "lib", "python3", "src", "main", "v2", "assets"]) for _ in range(5)),
        lambda: "thisIsCamelCase" + rng.choice(["Handler2", "Factory", "V2Builder"]),
        lambda: "release-2024.01.15-build" + draw("0123456789", 4),
        lambda: "EXAMPLEKEY" + draw("0123456789", 8),
    ]
    words = ["string", "nothing", "getpass", "required", "config.value", "os.environ", "settings.token", "changeme",
             "whatever", "optional", "undefined", "process.env"]
    names = ["token", "api_key", "secret", "password", "access_key", "TOKEN", "DB_PASSWORD"]
    quoted = [('{} = "', '"'), ("{}: '", "'"), ('export {}="', '"'), ('"{}": "', '",')]
    open_ = [("{}=", " "), ("{}: ", "\n"), ("{} = ", " "), ("export {}=", "\n"), ("?{}=", "&x=1")]
    sent = [("Authorization: Bearer ", " "), ("-H 'Authorization: token ", "'"), ("Bearer ", "\n")]
    address = [("https://user:", "@host.example/x "), ("https://", "@git.example/x.git "), ("postgres://app:", "@db:5432/x ")]
    bare = [("", " "), ("see ", " "), ("(", ")"), ("\n", "\n"), ("key ", ", ")]
    plain = ["{} ", "see {} ", "({} ", "{}: ", "{}=", "https://host.example/{}/", 'src="{}/', '"{}": "']
    found = []
    for i in range(n):
        label = i % 2
        if label:
            leads, values = rng.choice([
                (quoted, marked + unmarked), (open_, marked + unmarked), (sent, marked + unmarked), (address, marked + unmarked),
                (bare, marked),
            ])
            (lead, tail), value = rng.choice(leads), rng.choice(values)()
            lead = lead.format(rng.choice(names))
        elif rng.random() < 0.25:  # a name of a credential before what is none
            (lead, tail), value = rng.choice(quoted + open_), rng.choice(words)
            lead = lead.format(rng.choice(names))
        else:
            value = rng.choice(other)()
            lead = rng.choice(plain).format(rng.choice(["commit", "sha256", "id", "version", "image", "uuid"]))
            if "your_" in value or "EXAMPLE" in value or "xxx" in value:
                lead = rng.choice(quoted)[0].format("api_key")
            tail = lead[-1] if lead[-1] in "\"'" else " "
        text = f"of the {lead}{value}{tail} and more"
        start = len(f"of the {lead}")
        found.append((text.encode(), start, start + len(value), label))
    return found


def seed_findings(texts: list[bytes]) -> list[tuple[bytes, int, int, int]]:
    """Candidates of the texts that the name before them decides; the others stay unlabelled."""
    found = []
    for text in texts:
        for start, end in candidates(text):
            named = NAMED.search(text[max(0, start - 24) : start].lower())
            parts = re.findall(r"[a-z0-9]+", named.group(1).decode()) if named else []
            if not parts or not (parts[-1] in KEY_NAMES or parts[-1] in OTHER_NAMES):
                continue
            low = max(0, start - AROUND)
            found.append((text[low : end + AROUND], start - low, end - low, int(parts[-1] in KEY_NAMES)))
    return found


@dataclass
class Scanner:
    trees: list[Node]
    around: Surroundings
    threshold: float

    def scan(self, text: bytes, path: str = "") -> list[tuple[int, int, float]]:
        """(start, end, score) of the candidates that are kept."""
        spans = candidates(text)
        if not spans:
            return []
        x = np.array([features(text, s, e, self.around, path) for s, e in spans])
        scores = forest_values(self.trees, x)
        return [(s, e, float(v)) for (s, e), v in zip(spans, scores, strict=True) if v >= self.threshold]


def _named(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = seed_findings([text for text in byte_texts(batch) if text])
        columns = list(zip(*found, strict=True)) or [[]] * 4
        kinds = [pa.binary(), pa.int32(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["near", "start", "end", "label"]
        )


FINDINGS = "near binary, start int, end int, label int"
WIDTH = 24


def named_findings(docs: DataFrame) -> DataFrame:
    """(near, start, end, label): candidates of all texts that the name before them decides.

    near is the candidate with its surroundings, start and end its place there. What stands in
    several texts with the same surroundings is one finding.
    """
    return docs.select("text").mapInArrow(_named, FINDINGS).distinct()


def _vectors(around: Surroundings):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near, start, end = (batch.column(c).to_pylist() for c in ("near", "start", "end"))
            x = [features(t, s, e, around) for t, s, e in zip(near, start, end, strict=True)]
            kept = [batch.column(c) for c in ("key", "part", "label")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(x, pa.list_(pa.float64()))], names=["key", "part", "label", "x"])

    return emit


def train(found: DataFrame, around: Surroundings, threshold: float = 0.5, trees: int = 40) -> Scanner:
    """A scanner from a table of labelled findings: near, start, end, label and drawn (by rule, or not).

    Both labels weigh the same, and those drawn by rule at least as much as the others of their label.
    """
    key = F.xxhash64("near", "start", "end", "label", "drawn")
    part = (2 * F.col("drawn").cast("int") + F.col("label")).alias("part")
    narrow = found.select(key.alias("key"), part, "label", "near", "start", "end")
    rows = stored(narrow.mapInArrow(_vectors(around), "key long, part int, label int, x array<double>"))
    sizes = {r.part: r.n for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect()}
    weights = {p: min(1.0, sizes.get(p + 2, n) / n) for p, n in sizes.items()}
    by_label = [sum(weights[p] * n for p, n in sizes.items() if p % 2 == label) for label in (0, 1)]
    scaled = [(p, int(UNIT * w * sum(by_label) / 2 / by_label[p % 2])) for p, w in weights.items()]
    weight = F.element_at(F.create_map(*[F.lit(v).cast("long") for entry in scaled for v in entry]), F.col("part").cast("long"))
    weighted = rows.withColumn("weight", weight)
    return Scanner(grown(weighted, WIDTH, trees, depth=8, features=7, seed=23, least=3.0), around, threshold)


def sample_texts(docs: DataFrame, limit: int, max_chars: int) -> list[bytes]:
    """At most ``limit`` texts to look at, the same ones every time, half of them with an assignment.

    No scanner is trained on them: ``fitted`` reads all documents. They are picked by their hashes; whole texts move for those picked only, once each.
    """
    short = docs.select("text").where((F.length("text") <= max_chars) & (F.length("text") > 0))
    named = short.select(F.xxhash64("text").alias("hash"), F.col("text").rlike(r"[=:]\s?[\"']").alias("assigned"), "text")
    hashes = named.select("hash", "assigned").distinct()
    first, second = (hashes.where(part).orderBy("hash").limit(limit // 2) for part in (F.col("assigned"), ~F.col("assigned")))
    # ``limit`` hashes at most
    picked = named.join(F.broadcast(first.union(second).select("hash")), "hash")
    return sorted(r.text.encode() for r in picked.groupBy("hash").agg(F.min("text").alias("text")).collect())


def fitted(docs: DataFrame, threshold: float = 0.5) -> Scanner:
    """A scanner whose dictionary and named findings come from all documents; generated findings join them."""
    counts = word_counts(docs).persist(StorageLevel.DISK_ONLY)
    around, words = dictionary(counts)
    counts.unpersist()
    drawn = docs.sparkSession.createDataFrame(generated_findings(), FINDINGS).withColumn("drawn", F.lit(True))
    named = named_findings(docs).coalesce(max(8, words // WORDS_PER_PARTITION)).withColumn("drawn", F.lit(False))
    return train(named.unionByName(drawn.coalesce(1)), around, threshold)


def _paths(batch: pa.RecordBatch, path: str | None) -> list[str]:
    if path is None:
        return [""] * batch.num_rows
    return [p or "" for p in batch.column(batch.schema.get_field_index(path)).to_pylist()]


def _findings(scanner: Scanner):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = []
            for doc_id, text, path in zip(ids, byte_texts(batch), _paths(batch, "path"), strict=True):
                for start, end, score in scanner.scan(text or b"", path):
                    token = text[start:end].decode()
                    rows.append((doc_id, len(text[:start].decode()), len(token), token, score))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["doc_id", "start", "length", "secret", "score"],
            )

    return emit


def _masked(scanner: Scanner, path: str | None):
    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, where in zip(byte_texts(batch), _paths(batch, path), strict=True):
                for start, end, _ in reversed(scanner.scan(text or b"", where)):
                    text = text[:start] + MASKED + text[end:]
                texts.append(text)
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, pa.binary()).cast(pa.string()))

    return emit


def secrets(docs: DataFrame, scanner: Scanner, path: str | None = None) -> DataFrame:
    """(doc_id, start, length, secret, score): findings that the forest keeps.

    ``docs``: doc_id, text and, if named, a column with the path of each text; others are not
    read. start counts characters. Null and empty texts have no findings; a secret that stands
    twice is found twice, and repeated rows give repeated findings; an empty table gives none.
    """
    where = F.col(path).cast("string") if path else F.lit("")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", where.alias("path"))
    kinds = "doc_id long, start long, length long, secret string, score double"
    return read.mapInArrow(_findings(scanner), kinds)


def without_secrets(docs: DataFrame, scanner: Scanner, path: str | None = None) -> DataFrame:
    """``docs``, all rows and columns, with findings in ``text`` masked; a null text stays null."""
    return docs.mapInArrow(_masked(scanner, path), docs.schema)
