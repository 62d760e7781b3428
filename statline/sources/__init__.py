from statline.sources.keyed import KeyedTable
from statline.sources.landing import load_from_landing
from statline.sources.raw import confirm, ingest_raw, list_sources
from statline.sources.reports import write_report
from statline.sources.state import advance_mark, read_mark
from statline.sources.warehouse import ContractError, Warehouse

__all__ = [
    "ContractError", "KeyedTable", "Warehouse", "advance_mark", "confirm", "ingest_raw", "list_sources", "load_from_landing", "read_mark",
    "write_report",
]
