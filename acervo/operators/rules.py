"""Domain rules: rates by period, fee bands, review, fines, weighted scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acervo.functions.text import norm_ws

#: Fee bands in minimum wages, with least and greatest per cent.
BANDS = [(0, 200, 10, 20), (200, 2000, 8, 10), (2000, 20000, 5, 8), (20000, 100000, 3, 5), (100000, None, 1, 3)]
#: Below so many minimum wages a judgment against the entity needs no review.
REVIEW = {"UNIAO": 1000, "ESTADO": 500, "CAPITAL": 500, "MUNICIPIO": 100}
#: Fees that bands don't govern, and the share of proof that a standard asks for more than.
FLAT_FEES = {"monitory": 0.05, "execution": 0.1}
STANDARDS = {"preponderance": 50}
#: This library's own words of an outcome, in normal form. Refusals are looked for first, since some hold the words of a grant ("não provido").
CLITIC = r"(?:-(?:se|lhes?|o|a))?"
REFUSED = rf"\b(?:(?:des|im)provid[oa]s?|(?:des|im)provimento|improceden(?:tes?|cia)|neg(?:a|o|ar|ou|aram|ando|ado|ada){CLITIC}\s+(?:\w+\s+)?(?:provimento|seguimento|seguranca|ordem)|deneg(?:a|o|ar|ou|ad[oa]s?|acao){CLITIC}|nao\s+(?:(?:foi|foram|e|sao|se|ha|lhe|merece|deu|da|dar|conced\w+|resulta)\s+){{0,2}}(?:provid[oa]s?|provimento|proceden(?:tes?|cia)|concedid[oa]s?|seguranca|ordem|acolhid[oa]s?))\b"
GRANTED = rf"\b(?:provid[oa]s?|proceden(?:tes?|cia)|d(?:a|ou|ar|eu|eram|ando|ado){CLITIC}\s+(?:\w+\s+)?provimento|(?:parcial\s+provimento|provimento\s+parcial)|conced(?:e|o|er|eu|eram|id[oa]s?){CLITIC}|concessao\s+d[aeo]s?\s+(?:seguranca|ordem|tutela|liminar|beneficio|aposentadoria))\b"
SEVERITIES = ["critical", "high", "medium", "low"]
#: Weights of the scores.
DEVIATION, CAUSATION = (30, 25, 20, 15, 10), (25, 25, 20, 15, 15)
RELIABILITY = ["BAIXA", "MEDIA", "ALTA"]


def rates_at(rows: DataFrame, rates: DataFrame, key: str, day: str, buckets: str = "month") -> DataFrame:
    """Each row with the rate whose period has its day; an open period has no end.

    Periods are dealt to the calendar months that they touch, so the lookup is
    an equi-join with a check instead of a nested loop.  rates: key, start,
    end, rate, with `last` the last day that any open period is asked for.
    """
    months = rates.withColumn("_end", F.coalesce("end", "last")).withColumn("_month", F.explode(F.sequence(F.date_trunc(buckets, "start"), F.date_trunc(buckets, "_end"), F.expr("interval 1 month"))))
    periods = months.select(F.col(key).alias("_key"), "_month", F.col("start").alias("_start"), "_end", "rate")
    met = rows.withColumn("_in", F.date_trunc(buckets, day)).join(periods, (F.col(key) == F.col("_key")) & (F.col("_in") == F.col("_month")) & (F.col(day) >= F.col("_start")) & (F.col(day) <= F.col("_end")), "left")
    return met.drop("_key", "_month", "_start", "_end", "_in")


def by_bands(wages: Column, which: str = "min") -> Column:
    """A fee in minimum wages, band by band: each part of the value at its own band's per cent."""
    part = lambda lo, hi: F.greatest(F.lit(0).cast("decimal(18,4)"), (F.least(wages, F.lit(hi).cast("decimal(18,4)")) if hi else wages) - lo)
    return reduce(Column.__add__, [part(lo, hi) * F.lit((low if which == "min" else high)).cast("decimal(4,0)") for lo, hi, low, high in BANDS])


def review(entity: Column, wages: Column, inapplicable: Column, special: Column, precedent: Column) -> Column:
    """Whether a judgment goes to mandatory review, by the first rule that applies."""
    limit = reduce(lambda out, x: F.when(entity == x[0], x[1]).otherwise(out), REVIEW.items(), F.lit(None).cast("int"))
    return F.when(inapplicable, "not applicable").when(special, "special regime").when(wages < limit, "below the limit").when(precedent, "binding precedent").otherwise("review")


def fine(days: Column) -> Column:
    """0.33 per cent a day, 20 at most, in hundredths of a per cent."""
    return F.least(days * 33, F.lit(2000))


def simple_interest(principal: Column, rates: Column) -> Column:
    """Rates of simple interest add up."""
    return principal * (1 + F.aggregate(rates, F.lit(0).cast("decimal(18,6)"), lambda a, x: (a + x).cast("decimal(18,6)")))


def weighted(scores: list[Column], weights: tuple[int, ...]) -> Column:
    """0 to 100, of scores from 0 to 100."""
    return F.round(reduce(Column.__add__, [s * w for s, w in zip(scores, weights, strict=True)]) / 100, 2)


def conclusion(deviation: Column, causation: Column, harm: Column, exclusion: Column) -> Column:
    """By the first that holds."""
    low = F.least(deviation, causation)
    return F.when(exclusion, "excluded").when(~harm, "no harm").when(low >= 60, "characterised").when(low >= 40, "doubtful").otherwise("not characterised")


def reliability(*dimensions: Column) -> Column:
    """The lowest of all dimensions, not their mean."""
    rank = lambda c: F.array_position(F.array(*map(F.lit, RELIABILITY)), c)
    return F.get(F.array(*map(F.lit, RELIABILITY)), (F.least(*map(rank, dimensions)) - 1).cast("int"))


def evidence_map(rows: DataFrame, fact: str, favourable: Column) -> DataFrame:
    """PROVEN, REFUTED or UNDECIDED by the majority of a fact's evidence."""
    out = rows.groupBy(fact).agg(F.count("*").alias("n"), F.count_if(favourable).alias("n_for"))
    return out.withColumn("status", F.when(F.col("n_for") * 2 > F.col("n"), "PROVEN").when(F.col("n_for") * 2 < F.col("n"), "REFUTED").otherwise("UNDECIDED"))


def routed(confidence: Column) -> Column:
    """The tier of a classification cascade."""
    return F.when(confidence >= 0.8, "accept").when(confidence >= 0.7, "second model").otherwise("human")


def outcome(text: Column) -> Column:
    """refused or granted, by the words of a header or a disposition, whole words alone; null without such words."""
    n = norm_ws(text)
    return F.when(n.rlike(REFUSED), "refused").when(n.rlike(GRANTED), "granted")


def consistent(header: Column, disposition: Column) -> Column:
    """Whether a header announces what the disposition decides, by their words alone; unsure if either has none."""
    a, b = outcome(header), outcome(disposition)
    return F.when(a.isNull() | b.isNull(), "unsure").when(a == b, "consistent").otherwise("contradiction")


def severity_colour(verdict: Column) -> Column:
    """A contradiction of header and disposition is grave, an ambiguity is not."""
    return F.when(verdict == "contradiction", "RED").when(verdict == "unsure", "YELLOW").otherwise("GREEN")


def kept_corrections(rows: DataFrame, part: list[str], severity: str, conservative: list[str]) -> DataFrame:
    """The correction of each part that holds: the gravest, and of equally grave ones the most conservative (the least by these columns)."""
    rank = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col(severity))
    picked = rows.groupBy(*part).agg(F.min_by(F.struct(*rows.columns), F.struct(F.when(rank > 0, rank).otherwise(len(SEVERITIES) + 1), *conservative)).alias("_row"))
    return picked.select("_row.*")


def flat_fee(value: Column, variant: Column, other: Column) -> Column:
    """The fee of a variant with a rate of its own, else at the given rate."""
    return value * reduce(lambda out, x: F.when(variant == x[0], F.lit(x[1])).otherwise(out), FLAT_FEES.items(), other)


#: The least value, in minimum wages, from which a judgment against an entity is reviewed, with the entities that share it.
REVIEW_ENTITIES = {
    "Union": 1000, "federal agency": 1000, "federal foundation": 1000, "state": 500, "federal district": 500, "state agency": 500, "state foundation": 500, "capital": 500, "capital's agency": 500, "other municipality": 100, "other municipality's agency": 100,
}
#: Judgments that are reviewed whatever their value, and the multiple of the offer from which an expropriation is.
ALWAYS_REVIEWED = ["writ of mandamus granted", "popular action dismissed", "class action dismissed"]
EXPROPRIATION = 2
#: Fees by procedure in per cent, least and greatest; equal where the rule leaves no choice.
FEES_BY_PROCEDURE = {"monitory without embargoes": (5, 5), "monitory, embargoes rejected": (0, 10), "monitory, embargoes accepted": (10, 20), "execution": (10, 10), "rescission deposit": (5, 5)}


def review_value(entity: Column, minimum_wage: Column) -> Column:
    """The value, in money, from which a judgment against the entity is reviewed; null for an unknown entity."""
    known = F.create_map(*[F.lit(x) for pair in REVIEW_ENTITIES.items() for x in pair])
    return F.element_at(known, entity) * minimum_wage


def reviewed(entity: Column, value: Column, minimum_wage: Column, kind: Column, offer: Column) -> Column:
    """Whether a judgment is reviewed: always for some kinds, an expropriation by its multiple of the offer, others from their entity's value on."""
    return F.when(kind.isin(ALWAYS_REVIEWED), True).when(kind == "expropriation", value > EXPROPRIATION * offer).otherwise(value >= review_value(entity, minimum_wage))


def procedure_fees(value: Column, procedure: Column) -> Column:
    """struct(least, most): a procedure's fees, rounded to cents; null for an unknown one."""
    at = lambda i: F.element_at(F.create_map(*[F.lit(x) for k, v in FEES_BY_PROCEDURE.items() for x in (k, v[i])]), procedure)
    return F.struct(F.round(value * at(0) / 100, 2).alias("least"), F.round(value * at(1) / 100, 2).alias("most"))


def proof_percent(standard: Column) -> Column:
    """The share in percent that a standard of proof asks for more than; null where none is defined."""
    return reduce(lambda out, x: F.when(standard == x[0], x[1]).otherwise(out), STANDARDS.items(), F.lit(None).cast("int"))
