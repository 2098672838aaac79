"""Query for the streaming current-state operator."""

from __future__ import annotations

import os
import uuid

from tessera.operators.ordering import target_partitions
from tessera.plans.change_queries import _NET_SQL
from tessera.plans.fixtures import TRACKED, change_log
from tessera.plans.registry import query
from tessera.session import ensure_checkpoint_dir
from tessera.streaming.current_state import read_state, stream_current_state


@query("stream_current_state", f"""
WITH {_NET_SQL}
SELECT user_id, (SELECT max(event_id) FROM lg WHERE lg.user_id = cur.user_id) AS event_id,
       event_type, value, props
FROM cur WHERE last_op <> 'D'
""")
def stream_current_state_q(spark, sf):
    # the change log is landed as files in the shared folder and streamed
    # through (availableNow); the result is the state table it maintains
    base = os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), f"s1-{uuid.uuid4().hex}")
    log = change_log(spark, sf).select("user_id", "event_id", "op", *TRACKED)
    log.repartitionByRange(target_partitions(log), "event_id").write.parquet(f"{base}/log")
    q = stream_current_state(spark, f"{base}/log", log.schema, f"{base}/state", f"{base}/ckpt",
                             "user_id", "event_id", "op", TRACKED, max_files_per_trigger=3)
    q.awaitTermination()
    schema = log.drop("op").schema
    return read_state(spark, f"{base}/state", schema).select("user_id", "event_id", *TRACKED)
