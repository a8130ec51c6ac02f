"""URL filter: rules by host and path, and logistic regression on hashed character n-grams.

The model is trained in numpy from a small labelled table of URLs, given as a parameter; the package
brings one of its own (:mod:`corpusprep.llm.labelled_urls`). N-grams of host and path are hashed with different seeds,
so that a word means one thing in a host and another in a path. Rules are applied first, the longest that fits; all
other URLs get the model's verdict.

Defined results: a URL that is null or has no ``://`` has an empty host and path, fits no rule, and is
judged by the model's bias alone. Very long URLs are read whole. Equal URLs get equal verdicts; null and
repeated ids are rows like others; extra columns are dropped.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.llm import labelled_urls

BUCKETS = 1 << 14
NGRAMS = (3, 4, 5)
PRIOR = -2.0
#: Probability from which a URL is blocked: of names whose words were never seen, some 80 % of those to be blocked
#: are, and fewer than 2 % of ordinary others.
LIMIT = 0.58

@dataclass(frozen=True)
class Rule:
    """``host`` fits itself and its subdomains; ``path`` must begin the URL's path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the registered query (fixed values).
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where there is no ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct (name, verdict); null if none does."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def ngrams(part: str, seed: int, buckets: int = BUCKETS) -> np.ndarray:
    """Distinct hashed n-grams of a host (seed 1) or path (seed 2), with marks at its ends."""
    if not part:
        return np.zeros(0, np.int64)
    marked = f"^{part.lower()}$".encode("utf-8", "replace")
    found = {zlib.crc32(marked[i : i + n], seed) % buckets for n in NGRAMS for i in range(len(marked) - n + 1)}
    return np.fromiter(sorted(found), np.int64, len(found))


@dataclass
class Model:
    """A weight for each bucket. Host and path are each scaled to their own number of n-grams, so that a long
    path does not drown what the host says."""

    weights: np.ndarray
    bias: float

    def parts(self, host: str, path: str) -> list[np.ndarray]:
        return [at for at in (ngrams(host, 1, len(self.weights)), ngrams(path, 2, len(self.weights))) if len(at)]

    def probability(self, parts: list[np.ndarray]) -> float:
        z = self.bias + sum(self.weights[at].sum() / np.sqrt(len(at)) for at in parts)
        return float(1 / (1 + np.exp(-z)))

    def score(self, host: str, path: str) -> float:
        """Probability that a URL is to be blocked."""
        return self.probability(self.parts(host, path))


def train(
    labelled: Sequence[tuple[str, str, bool]] | None = None, buckets: int = BUCKETS, epochs: int = 40, rate: float = 0.5, decay: float = 1e-3, seed: int = 5
) -> Model:
    """Logistic regression by stochastic gradient descent over a labelled table (host, path, block, ...)."""
    # The prior: URLs to be blocked are few. Without evidence a URL is allowed.
    model = Model(np.zeros(buckets), PRIOR)
    table = labelled_urls.labelled() if labelled is None else labelled
    rows = [(model.parts(host, path), float(block)) for host, path, block, *_ in table]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            parts, truth = rows[i]
            gap = model.probability(parts) - truth
            for at in parts:
                model.weights[at] -= rate * (gap / np.sqrt(len(at)) + decay * model.weights[at])
    return model


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, model: Model | None = None, limit: float = LIMIT, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(id, host, path, rule, verdict, score) for every row; ``score`` is the model's, rule or not."""
    model = model or train()
    shared = pages.sparkSession.sparkContext.broadcast(model)  # of fixed size: one weight per bucket
    host, path = host_and_path(F.col(url_col).cast("string"))
    read = pages.select(pages[id_col].cast("long").alias("id"), host.alias("host"), path.alias("path"))

    def run(batches):
        import pyarrow as pa

        own = shared.value
        for batch in batches:
            scores = [own.score(h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])

    scored = read.mapInArrow(run, "id long, host string, path string, score double")
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    by_model = F.when(F.col("score") >= limit, "block").otherwise("allow")
    return scored.select("id", "host", "path", rule["name"].alias("rule"), F.coalesce(rule["verdict"], by_model).alias("verdict"), "score")
