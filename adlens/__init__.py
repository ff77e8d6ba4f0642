"""adlens: ad-attribution analytics on Spark DataFrames.

Layers: ``sources`` (JSONL, tables, driver adapter), ``operators`` (staging,
metrics, marts, reports, checks, validator, synthetic events, incremental
loads), ``functions`` (column expressions), ``plans`` (pipeline build,
landing job and the registered queries) and ``streaming`` (incremental file
ingest). The most used entry points are re-exported here.
"""

__version__ = "0.1.0"

from adlens.operators.checks import DECLARED_CHECKS, Check, run_checks  # noqa: E402,F401
from adlens.operators.incremental import (  # noqa: E402,F401
    incremental_rows, upsert, write_partitioned_by_date,
)
from adlens.operators.marts import (  # noqa: E402,F401
    mart_click_through_rate, mart_cost_per_install, mart_installs_reinstalls,
)
from adlens.operators.metrics import (  # noqa: E402,F401
    all_grain_metrics, grain_metrics, roll_up_published,
)
from adlens.operators.staging import rejected_events, stage_events  # noqa: E402,F401
from adlens.operators.synth import synth_events  # noqa: E402,F401
from adlens.operators.validate import (  # noqa: E402,F401
    batch_summary, batch_verdict, parsed_events, validate_lines,
)
from adlens.plans.pipeline import build  # noqa: E402,F401
from adlens.session import get_session, materialize  # noqa: E402,F401
from adlens.sources.jsonl import file_inventory, read_events, read_lines, write_events  # noqa: E402,F401
from adlens.streaming.ingest import ingest  # noqa: E402,F401
