"""A bounded memory of computed values, kept per Python worker."""

from __future__ import annotations


#: Keys above this length are computed each time, so the memory's bytes are bounded too.
LONGEST = 64


class Recent(dict):
    """Values of recent keys (strings or bytes), at most twice ``room``. When the young half is full it
    becomes the old one; an old value that is asked for again is young again. A subclass
    gives ``compute``; what is forgotten is computed anew, so results never change."""

    def __init__(self, room: int):
        super().__init__()
        self.room, self.old = room, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) > LONGEST:
            return value
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

    def compute(self, key):
        raise NotImplementedError
