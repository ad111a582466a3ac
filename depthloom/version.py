"""Version and commit of the code, for manifests."""

from __future__ import annotations

import functools
import subprocess
from pathlib import Path

VERSION = "0.2.0"


@functools.cache
def commit() -> str:
    """Short hash of the checkout this code lies in; ``unknown`` outside of one."""
    try:
        said = subprocess.run(["git", "rev-parse", "--short", "HEAD"], cwd=Path(__file__).parent, capture_output=True, text=True, check=True, timeout=10)
    except (OSError, subprocess.SubprocessError):
        return "unknown"
    return said.stdout.strip()
