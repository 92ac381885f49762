"""All registered queries by name."""

from __future__ import annotations

from ledgerline.registry import checks, spend, volume
from ledgerline.registry.common import Entry

ENTRIES: dict[str, Entry] = {**volume.ENTRIES, **spend.ENTRIES, **checks.ENTRIES}
