"""Things that users bring and that are dear to make: made in the workers, once each."""

from __future__ import annotations

import atexit
import uuid
from collections import OrderedDict
from collections.abc import Callable

#: What this worker has made, and how many things it keeps: the one that wasn't used for longest is closed first.
_MADE: OrderedDict[str, object] = OrderedDict()
MOST_MADE = 4


def _close(thing: object) -> None:
    if hasattr(thing, "close"):
        thing.close()


@atexit.register
def _close_all() -> None:
    while _MADE:
        _close(_MADE.popitem()[1])


class PerWorker:
    """What `make` gives, made when a worker's task first needs it and kept over batches and tasks; only `make` is shipped.

    Used in tasks as `with hook as thing`. With keep=False it is made once in each task and closed at its end, also when the
    task fails. A thing with a close() is closed when another takes its place or the worker ends by itself (Spark may kill
    idle workers: what must be closed in any case needs keep=False). Spark reuses workers unless it is told not to.
    """

    def __init__(self, make: Callable[[], object], keep: bool = True):
        self.make, self.keep, self.name = make, keep, uuid.uuid4().hex

    def __enter__(self) -> object:
        if self.name in _MADE:
            _MADE.move_to_end(self.name)
            return _MADE[self.name]
        while len(_MADE) >= MOST_MADE:
            _close(_MADE.popitem(last=False)[1])
        _MADE[self.name] = self.make()
        return _MADE[self.name]

    def __exit__(self, *_) -> None:
        if not self.keep and self.name in _MADE:
            _close(_MADE.pop(self.name))
