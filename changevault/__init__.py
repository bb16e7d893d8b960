"""changevault: change history of business records on Spark.

Extracts become typed, append-only history; history becomes current state; any past state can
be queried and exported again.
"""

from changevault.functions.coerce import coerce, coercion_rejects, required_violations
from changevault.functions.records import (
    align, extract_fields, job_status, spill_overflow, stringify, valid_record_ids,
)
from changevault.model import (
    ChangeVaultError, ColumnDef, DriftHalted, NothingToRestore, ObjectSpec, PartitionBy,
    RequiredValueMissing,
)
from changevault.objects import STANDARD_OBJECTS
from changevault.operators.latest import (
    before, last_good_state, latest_per_key, record_as_of, record_history, table_as_of,
)
from changevault.operators.lineage import (
    assign_canonical_id, canonical_ids, reference_edges, restore_levels, restore_plan, rewrite_parent_refs,
    rewrite_refs_to_any,
)
from changevault.operators.merge import merge_actions, merge_current
from changevault.operators.partitions import with_partitions
from changevault.operators.schema import (
    apply_removed_policy, columns_from_catalog, detect_drift, dry_run, evolve, removed_policy,
    type_changes, without_intentional,
)
from changevault.operators.watermark import (
    batch_watermark, drop_seen, incremental, job_start_watermark, watermarks,
)
from changevault.plans.current import merge_all, read_current, refresh_current
from changevault.plans.maintain import compact, expire, retained
from changevault.plans.restore import restore_export, restore_preview, restore_related
from changevault.plans.sync import sync_all, sync_frame, sync_object
from changevault.session import use_utc
from changevault.sources.canonical import read_ids, record_key, register_ids
from changevault.sources.extract import read_extract
from changevault.sources.ledger import get_watermark, live_commits, read_ledger
from changevault.sources.raw import append_raw, read_raw, read_rejects
from changevault.sources.restore_csv import write_restore_csv
from changevault.streaming.current import current_stream
from changevault.streaming.sync import sync_stream

__all__ = [name for name in dir() if not name.startswith("_")]
