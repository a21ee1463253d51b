"""seisma: multi-source event reconciliation on Spark (DataFrame / SQL / Structured Streaming).

Main entry points (all return lazy DataFrames unless noted):

    sources    parse_usgs, parse_emsc, parse_kandilli, to_raw, archive_raw, write_ndjson, load_ndjson
    operators  dedup_latest, stg, upsert, merge_into_days, match_candidates, mutual_best, reconcile,
               unify_events, daily_stats, hourly_counts, model_cost, daily_cost, cost_regression,
               run_cost_gate, expect_unique, expect_not_null, expect_accepted_values, run_contracts
    plans      build_models (materialise the model graph once), ingest_batch (one ingest run)
    streaming  stream_ingest, stream_ingest_docs, stream_hourly_counts, stream_candidates
"""

from seisma.operators.contracts import (  # noqa: F401
    Contract, expect_accepted_values, expect_not_null, expect_unique, run_contracts,
)
from seisma.operators.cost import cost_regression, daily_cost, model_cost, run_cost_gate  # noqa: F401
from seisma.operators.dedup import dedup_latest  # noqa: F401
from seisma.operators.marts import daily_stats, hourly_counts  # noqa: F401
from seisma.operators.matching import MatchConfig, match_candidates, mutual_best, reconcile  # noqa: F401
from seisma.operators.staging import stg  # noqa: F401
from seisma.operators.unify import unify_events  # noqa: F401
from seisma.operators.upsert import merge_into_days, upsert  # noqa: F401
from seisma.plans.ingest import ingest_batch  # noqa: F401
from seisma.plans.models import build_models  # noqa: F401
from seisma.sources.feeds import parse_emsc, parse_kandilli, parse_usgs, to_raw  # noqa: F401
from seisma.sources.landing import archive_raw, load_ndjson, write_ndjson  # noqa: F401
from seisma.sources.schemas import EMSC, KANDILLI, USGS, SourceSpec  # noqa: F401
from seisma.streaming.jobs import (  # noqa: F401
    stream_candidates, stream_hourly_counts, stream_ingest, stream_ingest_docs,
)
