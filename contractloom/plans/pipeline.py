"""The whole flows, as chains of lazy DataFrames. Nothing runs before a result is used."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractloom.operators import contracts, documents, flatten, reconcile, records, requests, responses
from contractloom.sources import record_store, tables


@dataclass(frozen=True)
class Positions:
    """What is known of a set of position files."""

    lines: DataFrame
    records: DataFrame
    rejects: DataFrame
    files: DataFrame
    limits: dict[str, int]
    wide: DataFrame
    unplaced: DataFrame

    def write(self, folder: str) -> tuple[str, str]:
        """The wide rows in order of first appearance, and the records that they have no columns for, as CSV in two folders."""
        return (tables.write_csv(self.wide, f"{folder}/wide", order=list(flatten.META_COLUMNS), drop=list(flatten.META_COLUMNS)),
                tables.write_csv(self.unplaced, f"{folder}/unplaced"))

    def mismatches(self, wide: DataFrame | None = None) -> DataFrame:
        return reconcile.mismatches(self.records, self.wide if wide is None else wide, self.limits)

    def report(self, wide: DataFrame | None = None) -> DataFrame:
        return reconcile.report(self.records, self.wide if wide is None else wide, self.limits)


def flatten_positions(spark: SparkSession, paths: str | list[str],
                      limits: dict[str, int] | None = None, store: str | None = None) -> Positions:
    """Files to records, rejects, file facts and wide rows.

    The text is read once, into a store (the folder ``store``, else one in the shared folder);
    all else reads that. Besides it, counting the occurrences is the only job that runs
    here, and only when ``limits`` is not given.
    """
    kept = record_store.build(spark, paths, store)
    lines, parsed = kept.lines(), kept.records()
    counted = limits is None
    limits = records.occurrence_limits(parsed) if counted else limits
    return Positions(
        lines=lines,
        records=parsed,
        rejects=kept.rejects(),
        files=kept.files(),
        limits=limits,
        wide=flatten.flatten(parsed, limits, counted=counted),
        unplaced=flatten.unplaced(parsed, limits),
    )


@dataclass(frozen=True)
class Quotes:
    """Contracts on their way to requests."""

    facts: DataFrame
    selected: DataFrame
    classified: DataFrame
    requests: DataFrame
    validation: DataFrame


def quote_requests(facts: DataFrame, *, run_ts: str, distributor: str | None = None,
                   **options: str) -> Quotes:
    """Contract facts to audited requests: de-duplicate, filter, classify, map, audit."""
    kept = contracts.filter_distributor(contracts.dedup_contracts(facts), distributor)
    selected = contracts.filter_active(kept)
    classified = contracts.classify(selected)
    mapped = requests.sync_arrangement(
        requests.map_requests(classified, run_ts=run_ts, **options))
    return Quotes(
        facts=facts,
        selected=kept,
        classified=classified,
        requests=mapped,
        validation=requests.enrich_failures(requests.validation_table(mapped)),
    )


def score_requests(mapped: DataFrame, *, timestamp: str,
                   order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Requests to documents with their outcome, and the scorecard. No row goes to the driver."""
    made = documents.document_table(mapped, order) if order else documents.render_documents(mapped)
    checked = documents.validate_documents(made)
    return (
        documents.with_outcome(checked, F.col("valid")),
        documents.scorecard(checked, timestamp=timestamp),
    )


def analyze_external(spark: SparkSession, path: str, *,
                     timestamp: str) -> tuple[DataFrame, DataFrame]:
    """Documents from elsewhere: analysis with outcome, and the enhanced scorecard."""
    analyzed = documents.analyze_documents(tables.read_documents(spark, path))
    return (
        documents.with_outcome(analyzed, F.col("status") == "PASS"),
        documents.enhanced_scorecard(analyzed, timestamp=timestamp),
    )


def evaluate_responses(answers: DataFrame, validation: DataFrame) -> dict[str, DataFrame]:
    """All views of a set of responses, by name."""
    crossed = responses.crossref_responses(answers, validation)
    return {
        "summary": responses.response_summary(answers),
        "by_code": responses.error_code_summary(answers),
        "by_type": responses.success_by_type(answers),
        "categories": responses.failure_categories(answers),
        "crossref": crossed,
        "crossref_summary": responses.crossref_summary(crossed, validation),
    }
