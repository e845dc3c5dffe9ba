"""Structured Streaming jobs.

The reference workloads are batch SQL (no streams, watermarks or event-time
windows), so the only continuous job is the append sink with its row
contract; every other operator is a batch DataFrame transformation that can
also run inside ``foreachBatch`` unchanged.
"""

from casework.streaming.contract_sink import run_contract_sink, start_contract_sink  # noqa: F401
