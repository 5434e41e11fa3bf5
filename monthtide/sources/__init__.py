"""Reading landed files: listing, gate, checksum, scan and schema conformance."""

from monthtide.sources.conform import conform, relax
from monthtide.sources.files import alike_files, footers, read_files
from monthtide.sources.landing import (
    MIN_SIZE,
    changed_landing,
    checksums,
    file_md5s,
    finished,
    gate,
    list_landing,
    manifest,
    pending_landing,
    row_digest,
)

__all__ = [
    "MIN_SIZE",
    "alike_files",
    "changed_landing",
    "checksums",
    "conform",
    "file_md5s",
    "finished",
    "footers",
    "gate",
    "list_landing",
    "manifest",
    "pending_landing",
    "read_files",
    "relax",
    "row_digest",
]
