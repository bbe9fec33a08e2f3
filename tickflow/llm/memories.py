"""What Python workers remember between tasks. A worker serves one stage after the other, so the memory of an
operator is let go of when a task of another one starts."""

from __future__ import annotations

from collections.abc import Callable

_clear: dict[str, Callable[[], None]] = {}


def remembers(name: str, clear: Callable[[], None]) -> None:
    _clear[name] = clear


def only(name: str) -> None:
    """Forget what all others but ``name`` remember."""
    for other, clear in _clear.items():
        if other != name:
            clear()
