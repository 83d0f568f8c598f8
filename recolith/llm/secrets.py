"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary
identifiers, compared by their log-likelihood ratio.

Both models are transition counts (previous two characters to the next, smoothed) over labelled samples,
counted by Spark; each is a table of at most ``len(ALPHABET) ** 3`` cells whatever the
samples' size. Tokens are runs of key characters, less what the patterns have found in them; each of at least
``MIN_TOKEN`` characters is a secret if the log-likelihood ratio a character exceeds the threshold. The models alone
decide: no kind of character has to be there. Scoring is one pass
over Arrow batches without a shuffle; positions are code points.

Defined cases: null and empty texts have no spans; repeated rows and null ids are scanned row by row; an empty table
gives none; a ratio equal to the threshold is no secret; spans that begin at one place come in the order of ``KINDS``; a very long text, or a very long
token, takes time and memory in proportion to its length; samples with null text or a label other than 0 and 1 are left out.
Other columns play no part, whatever their names.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import column

# Fixed patterns; letters of the keyword in either case, ASCII only.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "markov")
MIN_ASSIGN, MIN_ACCESS = 6, 20

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Fewest characters of a token: what is left to the models. Shorter ones tell too little.
MIN_TOKEN = 16
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+")
#: Log-likelihood ratio a character from which a token counts as random.
THRESHOLD = 0.1
SMOOTHING = 0.5

#: Parts of ordinary identifiers, which ``ENDINGS`` vary.
PARTS = (
    "access account action add admin alert alias api app archive array auth back base batch block body buffer build button cache call card cart change check child city class client clock cloud "
    "code color column config connect content count create current custom data date debug default delete detail device domain draft edit email entry error event export fetch field file filter first "
    "flag font form frame full get global graph group handle hash header hidden home host http icon image index info input invoice item job join json key kind label large last layer layout level "
    "limit line link list load lock login main map match max menu merge message method mode model name network next node number object offset open option order owner package page panel parent "
    "path payment phone pool port prefix price process product proxy query queue quick range rate read record region report request reset result retry role row rule save schema score search select "
    "server session shape size sort source stack start state stop store string style switch system table target task test text theme thread time title total track type user value vector view web window word year zone"
).split()
#: Words that long words of German, French and Spanish are made of.
WORDS = (
    "arbeit aufgabe bereich beschreibung bundes datei dienst ein entwicklung er fahrt freund ge gemein gesellschaft gesund heit kauf keit kirche kranken leistung lich mann nicht ordnung recht schaft schiff schule "
    "sicher sprache stadt stein ung unter ver versicherung verwaltung wirtschaft zeichen zeit zu ancien antes aquel ballon cambio communication comprendre connaissance contre "
    "desarrollo eau empresa encima ement ensemble entre environnement escuela esperanza gouvernement internacional maintenant mente nouveau "
    "nuestra pendant pensamiento personne pour quelque question raison semana siempre tiempo toujours trabajo travail ville"
).split()
ENDINGS = ("", "", "", "", "s", "er", "ing", "ed", "able", "ment", "ation")


def labelled_samples(n: int = 6000, seed: int = 7) -> list[tuple[str, int]]:
    """n random strings of the usual alphabets (label 1) and n ordinary identifiers (label 0): parts joined in the usual ways,
    half of them with numbers, long words of other languages, and one in twelve a plain number."""
    draw = random.Random(seed)
    lower, upper, digits = ALPHABET[:26], ALPHABET[26:52], ALPHABET[52:62]
    kinds = [digits + "abcdef", ALPHABET[:62], upper + digits, ALPHABET[:64], lower + digits, lower + upper, lower]
    rows = [("".join(draw.choices(draw.choice(kinds), k=draw.randint(16, 48))), 1) for _ in range(n)]
    for _ in range(n):
        parts = [draw.choice(PARTS) + draw.choice(ENDINGS) for _ in range(draw.randint(2, 6))]
        if draw.random() < 0.5:
            number = str(draw.choice([draw.randint(0, 9), draw.randint(10, 99), draw.randint(1990, 2030)]))
            parts.insert(draw.randint(1, len(parts)), number)
        style = draw.randint(0, 6)
        if style == 6:
            parts = draw.choices(WORDS, k=draw.randint(3, 6))
        if draw.random() < 1 / 12:
            rows.append(("".join(draw.choices(digits, k=draw.randint(16, 24))), 0))
            continue
        text = {0: "_", 1: "-", 2: "/"}.get(style, "").join([p.capitalize() for p in parts] if style in (3, 4) else parts)
        rows.append((text.upper() if style == 0 and draw.random() < 0.3 else text[0].lower() + text[1:] if style == 4 else text, 0))
    return rows


class Markov:
    """log-likelihood ratios of a third character after two, random against ordinary."""

    def __init__(self, ratios: np.ndarray) -> None:
        self.ratios = ratios
        self.at = {c: i for i, c in enumerate(ALPHABET)}

    def ratio(self, token: str) -> float:
        """A character's mean."""
        x = np.array([self.at[c] for c in token])
        return float(self.ratios[x[:-2], x[1:-1], x[2:]].mean()) if len(x) > 2 else 0.0


def train(samples: DataFrame, text_col: str = "text", label_col: str = "label") -> Markov:
    """Of labelled samples: 1 random, 0 ordinary. Characters outside the alphabet end a run."""
    n = len(ALPHABET)
    chars = F.split(F.regexp_replace(text_col, r"[^A-Za-z0-9+/_=-]", "\n"), "")
    triples = F.expr("transform(sequence(1, greatest(size(c) - 2, 1)), i -> array_join(slice(c, i, 3), ''))")
    rows = samples.where(F.col(text_col).isNotNull() & F.col(label_col).isin(0, 1)).select(F.col(label_col).alias("label"), chars.alias("c"))
    counts = np.full((2, n, n, n), 0.0)
    at = {c: i for i, c in enumerate(ALPHABET)}
    counted = rows.select("label", F.explode(triples).alias("t")).where("length(t) = 3 AND NOT contains(t, '\n')").groupBy("label", "t").count()
    for r in counted.collect():  # at most 2 * n ** 3 rows
        counts[(r["label"], *(at[c] for c in r["t"]))] += r["count"]
    # backed off to the character alone, so that pairs not seen tell nothing
    single = counts.sum(axis=(1, 2)) + SMOOTHING
    single = single / single.sum(axis=1, keepdims=True)
    given = (counts + n * SMOOTHING * single[:, None, None, :]) / (counts.sum(axis=3, keepdims=True) + n * SMOOTHING)
    return Markov(np.log(given[1]) - np.log(given[0]))


def trained(spark: SparkSession) -> Markov:
    return train(spark.createDataFrame(labelled_samples(), "text string, label int"))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of the fixed patterns, in order."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def left_of(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of key characters outside the base spans, in order: one walk along both."""
    at = 0
    for start, _, end in [*base, (len(text), 0, len(text))]:
        if start > at:
            yield from (m.span() for m in TOKEN.finditer(text, at, start))
        at = max(at, end)


def markov_spans(text: str, model: Markov, base: list[tuple[int, int, int]], threshold: float = THRESHOLD, least: int = MIN_TOKEN) -> list[tuple[int, int, int]]:
    return [(s, 3, e) for s, e in left_of(text, base) if e - s >= least and model.ratio(text[s:e]) > threshold]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, model: Markov, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id_col, n_assign, n_access, n_hex, n_markov (long), base and spans: kind:start:end, comma-joined."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                text = t.as_py() or ""
                base = base_spans(text)
                spans = sorted(base + markov_spans(text, model, base, threshold))
                rows.append((*(sum(s[1] == k for s in spans) for k in range(4)), joined(base), joined(spans)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=[id_col, "n_assign", "n_access", "n_hex", "n_markov", "base", "spans"])

    rows = docs.select(column(docs, id_col), column(docs, text_col).cast("string").alias("__text"))
    return rows.mapInArrow(run, StructType([rows.schema[0], *(StructField(f"n_{k}", LongType()) for k in KINDS), StructField("base", StringType()), StructField("spans", StringType())]))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns and n_markov."""
    found = scan(docs, trained(docs.sparkSession))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_markov")
