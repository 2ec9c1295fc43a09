"""Language identification by fusing text, markup, address and host evidence.

Text: a multinomial model of hashed byte trigrams per language, counted over all
given texts and their declared languages, against a uniform model ``und`` for
what is no language. Markup and address: P(declared | language) and
P(suffix | language), estimated from the text posteriors of all rows by grouped
sums. Host: a prior smoothed from host to domain to all rows, each row's own
share taken out. All tables that tasks hold are bounded by languages and
buckets; hosts and suffixes are joined.

Languages: the four fixed ones and every other one that enough rows declare
(``declared_languages``); a text of a rarer language is ``und`` at best.

Defined results: without a trigram the text says nothing and the other evidence
decides, and the row is not accepted; a null declared language, suffix or host
is a value of its own and says nothing about a host; an empty table gives an
empty result; rows are kept one by one, so repeated ids stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from wayfleet.llm import text as texts
from wayfleet.session import cut

# The languages always told apart, the name of what is none of them, and declared words that name no language.
LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
NO_LANGUAGE = ("und", "none", "other", "unknown", "null", "mul", "zxx")
LEAST_DECLARED, LEAST_SHARE = 20, 0.005     # rows, and share of the declared rows, that give a further language a class; so there are 200 at most
BUCKETS = 1 << 15
EFFECTIVE = 60.0        # trigrams of a text that count in full; evidence of longer texts grows no further
UNKNOWN_PRIOR = 1e-3
HOST_WEIGHT, DOMAIN_WEIGHT, TABLE_WEIGHT = 20.0, 50.0, 1.0
NONE = "none"


def _trigrams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each trigram inside a text, first trigram of each text and the end)."""
    low = texts.LOWER[data].astype(np.int64)
    low[texts.SPACE[data] | ((data >= 48) & (data < 58))] = 32
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    code = ((low[:-2] << 16) | (low[1:-1] << 8) | low[2:]).astype(np.uint64)
    bucket = (texts.mix(code) & np.uint64(BUCKETS - 1)).astype(np.int64)
    inside = np.ones(len(bucket), bool)
    for back in (1, 2):
        edge = at[1:-1] - back
        inside[edge[(edge >= 0) & (edge < len(bucket))]] = False
    # A run of blanks or digits says nothing.
    inside &= ~((low[:-2] == 32) & (low[1:-1] == 32))
    kept = np.concatenate([[0], np.cumsum(inside)])
    starts = kept[np.minimum(at, len(bucket))]
    return bucket[inside], starts


def _pieces(column: pa.Array, limit: int = 2 * texts.PIECE):
    data, at = texts.bytes_of(column)
    row = 0
    while row < len(at) - 1:
        end = min(max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1), len(at) - 1)
        yield row, end, data[at[row]:at[end]], at[row:end + 1] - at[row]
        row = end


@texts.tidied
def _count(languages: tuple[str, ...], batches):
    """Trigram counts of a task by language."""
    counts = np.zeros((len(languages), BUCKETS), np.int64)
    for batch in batches:
        lang = np.array([languages.index(x) if x in languages else -1 for x in batch.column("lang").to_pylist()], np.int64)
        for row, end, data, at in _pieces(batch.column("text")):
            bucket, starts = _trigrams(data, at)
            who = np.repeat(lang[row:end], np.diff(starts))
            known = who >= 0
            counts += np.bincount(who[known] * BUCKETS + bucket[known], minlength=counts.size).reshape(counts.shape)
    which, bucket = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(which), pa.array(bucket), pa.array(counts[which, bucket])], ["which", "bucket", "n"])


def _primary(declared: Column) -> Column:
    """First part of a declared language, in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(declared.cast("string"), F.lit("")), "^\\s*([A-Za-z]+)", 1))


def declared_languages(rows: DataFrame, lang_col: str = "lang") -> tuple[str, ...]:
    """The languages to tell apart: the fixed ones and those declared by at least ``LEAST_DECLARED`` rows and ``LEAST_SHARE`` of the declared ones."""
    counts = rows.groupBy(_primary(F.col(lang_col)).alias("lang")).agg(F.count(F.lit(1)).alias("n")).where((F.col("lang") != "") & ~F.col("lang").isin(*NO_LANGUAGE))
    counts = cut(counts, "declared")      # a row for each declared value
    declared = counts.agg(F.sum("n")).first()[0] or 0
    enough = counts.where((F.col("n") >= LEAST_DECLARED) & (F.col("n") >= LEAST_SHARE * declared)).select("lang")
    return tuple(sorted({*LANGUAGES, *(r["lang"] for r in enough.collect())}))


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", languages: tuple[str, ...] = LANGUAGES) -> np.ndarray:
    """Log-probabilities (bucket, language) over all rows; as many numbers as languages times buckets, whatever the table."""
    counted = (rows.select(F.col(text_col).cast("string").alias("text"), _primary(F.col(lang_col)).alias("lang"))
               .mapInArrow(lambda batches: _count(languages, batches), "which long, bucket long, n long")
               .groupBy("which", "bucket").agg(F.sum("n").alias("n")))
    table = np.full((BUCKETS, len(languages)), 0.5)
    for which, bucket, n in counted.collect():
        table[bucket, which] += n
    return np.log(table / table.sum(axis=0)).astype(np.float32)


def _evidence(model: np.ndarray):
    """Column function: log-likelihood of a whole text by language, ``und`` last, and the number of trigrams."""
    width = model.shape[1] + 2

    @arrow_udf("array<double>")
    def evidence(column: pa.Array) -> pa.Array:
        out = np.zeros((len(column), width))
        for row, end, data, at in _pieces(column):
            bucket, starts = _trigrams(data, at)
            n = np.diff(starts)
            for k in range(model.shape[1]):
                sums = np.concatenate([[0.0], np.cumsum(model[bucket, k], dtype=np.float64)])
                out[row:end, k] = sums[starts[1:]] - sums[starts[:-1]]
            out[row:end, -2] = -n * np.log(BUCKETS)
            out[row:end, :-1] *= (np.minimum(n, EFFECTIVE) / np.maximum(n, 1))[:, None]
            out[row:end, -1] = n
        texts.give_back()
        return pa.ListArray.from_arrays(np.arange(0, out.size + 1, width, dtype=np.int32), pa.array(out.reshape(-1)))

    return evidence


def score_texts(rows: DataFrame, model: np.ndarray, text: Column, declared: Column, suffix: Column, host: Column, domain: Column,
                languages: tuple[str, ...] = LANGUAGES) -> DataFrame:
    """``rows`` with the evidence of each kind in columns named _ev_*."""
    primary = _primary(declared)
    return rows.withColumns({
        "_ev_text": _evidence(model)(F.coalesce(text.cast("string"), F.lit(""))),
        "_ev_declared": F.when(primary == "", NONE).when(primary.isin(*languages), primary).otherwise(F.lit("other")),
        "_ev_suffix": F.coalesce(F.lower(suffix.cast("string")), F.lit(NONE)),
        "_ev_host": F.coalesce(F.lower(host.cast("string")), F.lit(NONE)),
        "_ev_domain": F.coalesce(F.lower(domain.cast("string")), F.lit(NONE)),
    })


def _normal(weights: list[Column]) -> list[Column]:
    total = sum(weights[1:], weights[0])
    return [w / total for w in weights]


def fuse(scored: DataFrame, languages: tuple[str, ...] = LANGUAGES, least: float = 0.5, prefix: str = "") -> DataFrame:
    """``scored`` with language, confidence and accepted (names after ``prefix``) in place of the _ev_* columns.

    ``scored`` is read twice, for the grouped sums and for the result.
    """
    classes = [*languages, UNKNOWN]
    lines = [F.get("_ev_text", F.lit(k)) for k in range(len(classes))]
    best = F.greatest(*lines)
    prior = {c: UNKNOWN_PRIOR if c == UNKNOWN else (1 - UNKNOWN_PRIOR) / len(languages) for c in classes}
    alone = _normal([F.exp(x - best) * F.lit(prior[c]) for x, c in zip(lines, classes, strict=True)])
    # A row without trigrams has no say in the sums.
    says = (F.get("_ev_text", F.lit(len(classes))) > 0).cast("double")
    rows = scored.withColumns({f"_ev_p{k}": p * says for k, p in enumerate(alone)} | {"_ev_says": says})
    sums = [F.sum(f"_ev_p{k}").alias(f"s{k}") for k in range(len(classes))]
    cells = rows.groupBy("_ev_declared", "_ev_suffix", "_ev_host", "_ev_domain").agg(*sums, F.sum("_ev_says").alias("n"))
    cells = cut(cells, "language")   # a row for each kind of address, without texts
    again = [F.sum(f"s{k}").alias(f"s{k}") for k in range(len(classes))]
    whole = cells.agg(*again, F.sum("n").alias("n")).first()
    total = [float(whole[k] or 0.0) for k in range(len(classes))]
    n = float(whole["n"] or 0.0)
    overall = [(total[k] + TABLE_WEIGHT * prior[c]) / (n + TABLE_WEIGHT) for k, c in enumerate(classes)]

    def given(column: str, name: str) -> DataFrame:
        """log P(value | class), smoothed."""
        kinds = cells.groupBy(column).agg(*again)
        return cut(kinds.select(column, *[F.log((F.col(f"s{k}") + 0.5) / F.lit(total[k] + 5.0)).alias(f"{name}{k}") for k in range(len(classes))]), "kinds")

    domains = cells.groupBy("_ev_domain").agg(*again, F.sum("n").alias("n")).select(
        "_ev_domain", *[((F.col(f"s{k}") + DOMAIN_WEIGHT * overall[k]) / (F.col("n") + DOMAIN_WEIGHT)).alias(f"d{k}") for k in range(len(classes))])
    hosts = (cells.groupBy("_ev_host", "_ev_domain").agg(*again, F.sum("n").alias("n")).join(domains, "_ev_domain")
             .select("_ev_host", "_ev_domain", F.col("n").alias("_ev_n"), *[F.col(f"s{k}").alias(f"h{k}") for k in range(len(classes))],
                     *[f"d{k}" for k in range(len(classes))]))
    # Written tables, so that each join with the rows has an exchange of its own that AQE can split, or is broadcast by its size.
    hosts = cut(hosts, "hosts")
    joined = (rows.join(given("_ev_declared", "_ev_m"), "_ev_declared", "left").join(given("_ev_suffix", "_ev_x"), "_ev_suffix", "left")
              .join(hosts.withColumnsRenamed({f"{a}{k}": f"_ev_{a}{k}" for a in "hd" for k in range(len(classes))}), ["_ev_host", "_ev_domain"], "left"))
    placed = F.col("_ev_host") != NONE
    host = [F.when(placed, (F.greatest(F.col(f"_ev_h{k}") - F.col(f"_ev_p{k}"), F.lit(0.0)) + HOST_WEIGHT * F.col(f"_ev_d{k}"))
                   / (F.col("_ev_n") - F.col("_ev_says") + HOST_WEIGHT)).otherwise(F.lit(overall[k])) for k in range(len(classes))]
    fused = [lines[k] + F.col(f"_ev_m{k}") + F.col(f"_ev_x{k}") + F.log(host[k]) for k in range(len(classes))]
    joined = joined.withColumns({f"_ev_f{k}": x for k, x in enumerate(fused)})
    fused = [F.col(f"_ev_f{k}") for k in range(len(classes))]
    top = F.greatest(*fused)
    shares = sum([F.exp(x - top) for x in fused[1:]], F.exp(fused[0] - top))
    name = F.coalesce(*[F.when(x == top, F.lit(c)) for x, c in zip(fused, classes, strict=True)])
    out = joined.withColumns({f"{prefix}language": name, f"{prefix}confidence": F.round(1 / shares, 6)})
    out = out.withColumn(f"{prefix}accepted", (F.col(f"{prefix}language") != UNKNOWN) & (F.col(f"{prefix}confidence") >= least) & (F.col("_ev_says") > 0))
    return out.drop(*[c for c in out.columns if c.startswith("_ev_")])


def page_text(html: Column) -> Column:
    """What a page shows: without scripts, styles, comments and tags."""
    return F.regexp_replace(F.coalesce(html.cast("string"), F.lit("")), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")


def page_address(url: Column) -> tuple[Column, Column, Column]:
    """(suffix, host, domain) of an address."""
    host = F.nullif(F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    labels = F.split(host, r"\.")
    return F.element_at(labels, -1), host, F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")


def identify_pages(spark: SparkSession, pages: DataFrame, training: DataFrame) -> DataFrame:
    """(page_id, host, language, confidence, accepted) of every page."""
    suffix, host, domain = page_address(F.col("url"))
    declared = F.regexp_extract(F.coalesce(F.col("html"), F.lit("")), r"(?is)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    rows = pages.select("page_id", host.alias("host"), page_text(F.col("html")).alias("shown"), declared.alias("declared"), suffix.alias("suffix"), domain.alias("domain"))
    languages = declared_languages(training)
    scored = score_texts(rows, train(training, languages=languages), F.col("shown"), F.col("declared"), F.col("suffix"), F.col("host"), F.col("domain"), languages)
    scored = cut(scored.drop("shown", "suffix", "domain"), "scored")
    return fuse(scored, languages).select("page_id", "host", "declared", "language", "confidence", "accepted")


def identify_documents(docs: DataFrame, text_col: str = "text", declared_col: str = "lang", host_col: str = "source", prefix: str = "") -> DataFrame:
    """``docs`` with language, confidence, accepted (names after ``prefix``): the declared column stands for markup, the source for the host."""
    none = F.lit(None).cast("string")
    languages = declared_languages(docs, declared_col)
    model = train(docs, text_col, declared_col, languages)
    return fuse(score_texts(docs, model, F.col(text_col), F.col(declared_col), none, F.col(host_col), F.lit("sources"), languages), languages, prefix=prefix)
