"""A key-value store in a folder, for tests: tasks and driver share the disk."""

from __future__ import annotations

import glob
import json
import os


class FileStore:
    def __init__(self, path: str, poison: str | None):
        self.path, self.poison, self.held = path, poison, {}

    def _part(self, part: str) -> str:
        return f"{self.path}/part-{part}"

    def stage(self, part, key, label, entry):
        if label == self.poison:
            raise OSError("refused")
        self.held.setdefault(part, []).append([key, label, entry])

    def show(self, parts):
        shown = self.entries()
        for part in sorted(parts):
            if os.path.exists(self._part(part)):
                with open(self._part(part)) as f:
                    shown |= {(k, label): entry for k, label, entry in json.load(f)}
                os.remove(self._part(part))
        with open(f"{self.path}/shown", "w") as f:
            json.dump([[*k, entry] for k, entry in shown.items()], f)

    def discard(self, parts):
        for part in parts:
            if os.path.exists(self._part(part)):
                os.remove(self._part(part))

    def close(self):
        for part, entries in self.held.items():
            with open(self._part(part), "w") as f:
                json.dump(entries, f)

    def entries(self):
        if not os.path.exists(f"{self.path}/shown"):
            return {}
        with open(f"{self.path}/shown") as f:
            return {(k, label): entry for k, label, entry in json.load(f)}

    def parts(self):
        return glob.glob(f"{self.path}/part-*")


def connect(options) -> FileStore:
    return FileStore(options["path"], options.get("poison"))
