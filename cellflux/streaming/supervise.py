"""Watch running queries until they end, fail, or run out of time."""

from __future__ import annotations

import time
from collections.abc import Sequence
from contextlib import ExitStack
from typing import Literal

from pyspark.sql.streaming import StreamingQuery

Outcome = Literal["finished", "stopped", "time_limit"]


def supervise(
    queries: Sequence[StreamingQuery],
    *,
    time_limit_seconds: float | None = None,
    poll_seconds: float = 10.0,
    until_all_end: bool = False,
) -> Outcome:
    """Wait for the queries; stop all of them on the way out, whatever happened.

    The failure of any query is raised. Otherwise the result is ``finished`` when
    all ended and `until_all_end` asked for that, ``stopped`` when one ended that
    should have run on, and ``time_limit`` when the time was up.
    """
    deadline = None if time_limit_seconds is None else time.monotonic() + time_limit_seconds
    with ExitStack() as on_exit:
        for query in queries:
            on_exit.callback(query.stop)  # each one, even if stopping another fails
        while True:
            # Activity first: a query seen as ended has its failure, if any, set by then.
            active = [query for query in queries if query.isActive]
            for query in queries:
                if failure := query.exception():
                    raise failure
            if until_all_end and not active:
                return "finished"
            if not until_all_end and len(active) < len(queries):
                return "stopped"
            wait = poll_seconds
            if deadline is not None:
                wait = min(wait, deadline - time.monotonic())
                if wait <= 0:
                    return "time_limit"
            active[0].awaitTermination(wait)  # raises if this query fails
