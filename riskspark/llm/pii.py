"""Personal data: fixed patterns, and spans that a conditional random field adds to them.

The patterns give the base spans: e-mail addresses, IP addresses, card numbers that pass the Luhn test and phone numbers
with a leading plus. The field reads lines as chains of words and tags the same kinds in other notations: spelled-out
addresses, phone numbers without a plus, addresses with bracketed dots, card numbers that the pattern misses since other
digits stand next to them. Of its spans those count that don't overlap a base span and hold what their kind needs.

Lines without a digit, an @, or a spelled-out "at" or "dot" before or in a domain aren't decoded: no span in them could
count.

Defined cases: a null or empty text has no spans; rows that repeat a doc_id are searched one by one; texts and lines of any
length are searched whole, at about 20 bytes a word of the longest line; patterns run in time proportional to the text. Other
columns are ignored by ``find`` and kept by ``masked``, whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import crf
from riskspark.llm.common import table
from riskspark.llm.crf import KINDS, luhn
from riskspark.llm.grams import groups

Span = tuple[int, int]

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: A line is decoded if it holds one of these.
TELLING = re.compile(r"[0-9@]|[\[({](?:dot|at)[\])}]|\bdot\b|\sat\s+[A-Za-z0-9-]+\.", re.IGNORECASE)
WORD = re.compile(r"\S+")
MASKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>"}
WORDS_KEPT = 1 << 18
#: Characters of texts that are searched together, and of a line that is decoded in pieces.
TOGETHER, LONG_LINE = 2_000_000, 1_000_000


def emails(text: str) -> list[Span]:
    """Every @ with a domain, and the run of local characters before it. No run is read twice."""
    out, done = [], 0
    at = text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at)
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        # The local characters end before this @ and the next run begins after it.
        done = max(done, at + 1)
        if domain and start < at:
            out.append((start, domain.end()))
            done = domain.end()
        at = text.find("@", done)
    return out


def ips(text: str) -> list[Span]:
    return [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split("."))]


def cards(text: str) -> list[Span]:
    out = []
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 40 and 16 <= len(digits := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    return [m.span() for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def base_spans(text: str) -> dict[str, list[Span]]:
    if not text or not TELLING.search(text):
        return {k: [] for k in KINDS}
    return {"email": emails(text) if "@" in text else [], "ip": ips(text), "card": cards(text), "phone": phones(text) if "+" in text else []}


def holds(kind: str, found: str) -> bool:
    """Whether a tagged span holds what its kind needs."""
    digits = re.sub("[^0-9]", "", found)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits) and re.fullmatch(r"[0-9](?:[ .\t-]{0,3}[0-9])+", found) is not None
    if kind == "phone":
        return 10 <= len(digits) <= 15 and re.fullmatch(r"\+?\(?[0-9][ ().0-9/-]*", found) is not None and re.search("[-() ]", found) is not None
    if kind == "ip":
        parts = re.fullmatch(r"([0-9]{1,3})" + r"(?:\.|\[\.\]|\(\.\))([0-9]{1,3})" * 3, found)
        return parts is not None and all(int(p) <= 255 for p in parts.groups())
    at, dot = r"(?:\s*[\[({]at[\])}]\s*|\s+at\s+|@)", r"(?:\s*[\[({]dot[\])}]\s*|\s+dot\s+|\.)"
    return re.fullmatch(rf"[A-Za-z0-9._%+-]+{at}[A-Za-z0-9-]+(?:{dot}[A-Za-z0-9-]+)+", found, re.IGNORECASE) is not None


class Finder:
    """Spans of many texts at once. Descriptions of words are kept."""

    def __init__(self, model: crf.Model):
        self.model, self.known = model, {}

    def describe(self, word: str) -> tuple[int, ...]:
        if word not in self.known:
            if len(self.known) > WORDS_KEPT:
                self.known.clear()
            self.known[word] = crf.describe(word)
        return self.known[word]

    def added(self, texts: list[str], base: list[dict[str, list[Span]]]) -> list[dict[str, list[Span]]]:
        """What the field adds to the base spans of each text."""
        words, places, lengths, owners = [], [], [], []
        out = [{k: [] for k in KINDS} for _ in texts]
        for owner, text in enumerate(texts):
            for low, high in telling_lines(text):
                if high - low > LONG_LINE:
                    self._long_line(text, low, high, base[owner], out[owner])
                    continue
                own = [m.span() for m in WORD.finditer(text, low, high)]
                places += own
                words += [self.describe(text[a:b]) for a, b in own]
                lengths.append(len(own))
                owners.append(owner)
        tags = crf.decode(self.model, np.array(words, np.int64).reshape(len(words), len(crf.SIZES)), np.array(lengths, np.int64))
        at = 0
        for owner, length in zip(owners, lengths, strict=True):
            self._counted(texts[owner], tagged(tags[at : at + length], places[at : at + length]), base[owner], out[owner])
            at += length
        return out

    def _counted(self, text: str, runs: Iterator[tuple[str, int, int]], base: dict[str, list[Span]], out: dict[str, list[Span]]) -> None:
        """Adds the spans of tagged runs that hold what they need and overlap nothing."""
        for kind, low, high in runs:
            span = trimmed(kind, text, low, high)
            if span and holds(kind, text[slice(*span)]):
                others = (s for k in KINDS for s in (*base[k], *out[k]))
                if not any(a < span[1] and span[0] < b for a, b in others):
                    out[kind].append(span)

    def _long_line(self, text: str, low: int, high: int, base: dict[str, list[Span]], out: dict[str, list[Span]]) -> None:
        """The same for a line that is too long to be laid out: words are described a piece at a time, and once more where
        they are tagged."""

        def described() -> Iterator[np.ndarray]:
            words = (self.describe(m[0]) for m in WORD.finditer(text, low, high))
            while piece := list(islice(words, 10_000)):
                yield np.array(piece, np.int64)

        tags = crf.decode_long(self.model, described())
        run: list[Span] = []
        own: list[int] = []
        for tag, m in zip(tags, WORD.finditer(text, low, high), strict=True):
            if tag:
                own.append(tag)
                run.append(m.span())
            elif run:
                self._counted(text, tagged(np.array(own), run), base, out)
                run, own = [], []
        if run:
            self._counted(text, tagged(np.array(own), run), base, out)


def telling_lines(text: str) -> Iterator[Span]:
    """The lines of a text that hold something telling."""
    at = 0
    while found := TELLING.search(text, at):
        low = text.rfind("\n", at, found.start()) + 1 or at
        high = text.find("\n", found.end())
        high = len(text) if high < 0 else high
        yield low, high
        at = high + 1


def tagged(tags: np.ndarray, places: list[Span]) -> Iterator[tuple[str, int, int]]:
    """Runs of tags: kind, first character, end."""
    k = 0
    while k < len(tags):
        if not tags[k]:
            k += 1
            continue
        kind, low = (int(tags[k]) - 1) // 2, places[k][0]
        inside = 2 * kind + 2
        k += 1
        while k < len(tags) and tags[k] == inside:
            k += 1
        yield KINDS[kind], low, places[k - 1][1]


def trimmed(kind: str, text: str, low: int, high: int) -> Span | None:
    """The span without punctuation around it."""
    ends = "([{0123456789" if kind in ("phone",) else "0123456789" if kind != "email" else "".join(LOCAL_CHARS)
    while low < high and text[low] not in ends + "+" * (kind == "phone"):
        low += 1
    last = "0123456789" if kind != "email" else "".join(c for c in LOCAL_CHARS if c.isalnum())
    while low < high and text[high - 1] not in last:
        high -= 1
    return (low, high) if low < high else None


def joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_added long, base_sha256 string, spans string"
)


def find(docs: DataFrame, model: crf.Model) -> DataFrame:
    """doc_id, the numbers of base spans, n_added, a digest of the base spans and all spans of each row of docs
    (doc_id, text). Positions are code points, the end is exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for batch in batches:
            for rows in groups(pc.utf8_length(batch.column(1)).fill_null(0).to_pylist(), TOGETHER):
                part = batch.slice(rows.start, rows.stop - rows.start)
                texts = [t or "" for t in part.column(1).to_pylist()]
                base = [base_spans(t) for t in texts]
                added = finder.added(texts, base)
                every = [{k: b[k] + a[k] for k in KINDS} for a, b in zip(added, base, strict=True)]
                columns = [pa.array([len(b[k]) for b in base], pa.int64()) for k in KINDS]
                columns.append(pa.array([sum(map(len, a.values())) for a in added], pa.int64()))
                columns.append(pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base]))
                columns.append(pa.array([joined(s) for s in every]))
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], [c.split()[0] for c in SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, SCHEMA)


def masked(docs: DataFrame, model: crf.Model) -> DataFrame:
    """``docs`` with every span of its text replaced by the name of its kind, and n_chars, if there is one, to match."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for batch in batches:
            for rows in groups(pc.utf8_length(batch.column(place)).fill_null(0).to_pylist(), TOGETHER):
                part = batch.slice(rows.start, rows.stop - rows.start)
                texts = part.column(place).to_pylist()
                plain = [t or "" for t in texts]
                base = [base_spans(t) for t in plain]
                added = finder.added(plain, base)
                new = [t and mask(t, {k: b[k] + a[k] for k in KINDS}) for t, a, b in zip(texts, added, base, strict=True)]
                columns = list(part.columns)
                columns[place] = pa.array(new, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    out = docs.mapInArrow(replace, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mask(text: str, spans: dict[str, list[Span]]) -> str:
    """Spans of different kinds may overlap: what they cover together is replaced once, by the first one's name."""
    out, at = [], 0
    for low, high, kind in sorted((a, b, k) for k in KINDS for a, b in spans[k]):
        if low >= at:
            out += [text[at:low], MASKS[kind]]
        at = max(at, high)
    return "".join(out) + text[at:]


def labelled_table(chains: int = 400, seed: int = 7) -> pd.DataFrame:
    """A small labelled table of chain, position, word, tag, made from a few sentence patterns."""
    rnd = random.Random(seed)
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    name = lambda: "".join(rnd.choice("abcdefghiklmnoprstuvw") for _ in range(rnd.randint(2, 9)))

    def card(valid: bool) -> str:
        while True:
            number = digits(16)
            if luhn(number) == valid:
                return number

    quads = lambda n: [n[k : k + 4] for k in range(0, 16, 4)]
    ip = lambda dot=".": dot.join(str(rnd.randint(0, 255)) for _ in range(4))
    user, host = lambda: rnd.choice([name(), f"{name()}.{name()}", f"{name()}{digits(2)}"]), name

    def found() -> tuple[str, list[str]]:
        return rnd.choice([
            lambda: ("email", [f"{user()}@{host()}.{rnd.choice(['com', 'org', 'example.com'])}"]),
            lambda: ("email", [user(), "at", host(), "dot", rnd.choice(["com", "org", "net"])]),
            lambda: ("email", [user(), rnd.choice(["[at]", "(at)"]), host(), rnd.choice(["[dot]", "(dot)"]), rnd.choice(["com", "org", "net"])]),
            lambda: ("email", [user(), rnd.choice(["[at]", "(at)", "at"]), f"{host()}.{rnd.choice(['com', 'org', 'net', 'example.com'])}"]),
            lambda: ("ip", [ip()]), lambda: ("ip", [ip("[.]")]),
            lambda: ("card", [card(True)]), lambda: ("card", [card(True)]), lambda: ("card", [".".join(quads(card(True)))]),
            lambda: ("phone", ["+" + digits(rnd.randint(1, 3)), f"({digits(3)})", f"{digits(3)}-{digits(4)}"]),
            lambda: ("phone", [f"({digits(3)})", f"{digits(3)}-{digits(4)}"]), lambda: ("phone", [f"{digits(3)}-{digits(3)}-{digits(4)}"]),
        ])()

    def plain() -> list[str]:
        return rnd.choice([
            lambda: [name()], lambda: [name()], lambda: [name() + rnd.choice(".,!?")], lambda: [name().title()], lambda: [name().upper() + "!!"],
            lambda: [name() + rnd.choice(["###", "&&&", "%%%", "$$$", "***"])], lambda: ["at"], lambda: ["|"], lambda: [digits(rnd.randint(1, 12))],
            lambda: [card(False)], lambda: [f"20{digits(2)}-0{digits(1)}-1{digits(1)}"], lambda: [f"{digits(1)}.{digits(1)}.{digits(1)}"],
            lambda: ["token", "=", '"' + "".join(rnd.choice("0123456789abcdef") for _ in range(40)) + '"'], lambda: [f"${digits(2)}.{digits(2)}"],
            lambda: [f"{digits(2)}:{digits(2)}"], lambda: ["Version", "2.0."], lambda: ["connect", "the", "dot", "here"], lambda: [f"@{name()}"],
        ])()

    rows = []
    for chain in range(chains):
        words: list[tuple[str, str]] = []
        for _ in range(rnd.randint(1, 6)):
            # A line may begin with what is looked for.
            if words or rnd.random() < 0.7:
                words += [(w, "O") for w in plain()]
            if rnd.random() < 0.5:
                kind, own = found()
                end = rnd.choice(["", "", "", ".", ",", "###", "&&&"])
                words += [(w + end * (k == len(own) - 1), f"{'I' if k else 'B'}-{kind}") for k, w in enumerate(own)]
        rows += [(chain, k, w, t) for k, (w, t) in enumerate(words)]
    return pd.DataFrame(rows, columns=["chain", "position", "word", "tag"])


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find(table(spark, sf_dir, "documents"), crf.train(labelled_table()))
