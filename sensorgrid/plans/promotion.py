"""Promotion from development to production as a batch job with an exit status."""

from __future__ import annotations

import sys

from sensorgrid.session import build_session
from sensorgrid.sources.tables import transfer_tables


def main(root: str) -> int:
    report, status = transfer_tables(build_session(app="promotion"), root)
    report.show(truncate=False)
    return status


if __name__ == "__main__":
    sys.exit(main(sys.argv[1]))
