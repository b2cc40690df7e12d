"""Writers for published datasets and their verification."""

from tripgrain.sinks.datasets import (
    contract_violations,
    read_csv_back,
    verified_evidence,
    verified_extract,
    write_csv,
    write_evidence,
    write_json,
)

__all__ = ["contract_violations", "read_csv_back", "verified_evidence", "verified_extract", "write_csv", "write_evidence", "write_json"]
