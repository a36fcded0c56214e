"""Figures out of streaming progress reports."""

from __future__ import annotations

from collections import Counter

from pyspark.sql.streaming import StreamingQueryListener


class ObservedTotals(StreamingQueryListener):
    """Adds up observed counts of every query of the session; see `spark.streams.addListener`.

    A batch that is run again after a failure reports again. Where counts must be exact take those that
    the streams leave per batch in their side folder (`runners.read_ledger`).
    """

    def __init__(self) -> None:
        self.totals: dict[str, Counter[str]] = {}
        self.end_offsets: dict[str, list[str]] = {}  # see metrics.positions_from_progress
        self.late: Counter[str] = Counter()  # rows a watermark kept out of state; of records counted per task one row a window
        self.state_rows: dict[str, int] = {}  # rows in state after the last micro-batch
        self.behind: dict[str, list[dict[str, str]]] = {}  # a broker's source tells its lag itself

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = event.progress
        for name, observed in report.observedMetrics.items():
            counts = {key: value or 0 for key, value in observed.asDict().items()}
            self.totals.setdefault(name, Counter()).update(counts)
        self.end_offsets[report.name] = [source.endOffset for source in report.sources]
        self.late[report.name] += sum(state.numRowsDroppedByWatermark for state in report.stateOperators)
        if report.stateOperators:
            self.state_rows[report.name] = sum(state.numRowsTotal for state in report.stateOperators)
        self.behind[report.name] = [dict(source.metrics) for source in report.sources]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
