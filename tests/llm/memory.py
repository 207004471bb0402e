"""Memory that a step takes."""

import tracemalloc
from collections.abc import Callable


def peak(step: Callable) -> int:
    """Bytes of Python and numpy at the highest, in a second call."""
    step()
    tracemalloc.start()
    step()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most
