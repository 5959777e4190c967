"""A folder's state as numbered records, each written once.

Data lies in layers, folders of their own that are never changed. A record names the layers
that count and what else a reader must know. Readers take the highest record; a writer
adds the next number to the one it read, and gets a ``Conflict`` where that number exists.
"""

from __future__ import annotations

import json
import os
import uuid

import pyarrow.fs as pafs

from likeness.session import open_filesystem


class Conflict(RuntimeError):
    """Another job wrote here since it was read."""


class CommitLog:
    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.filesystem, inner = open_filesystem(self.path)
        self.folder = f"{inner}/commits"

    def numbers(self) -> list[int]:
        found = self.filesystem.get_file_info(pafs.FileSelector(self.folder, allow_not_found=True))
        return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json") and f.base_name[:-5].isdigit())

    def latest(self) -> tuple[int, dict]:
        """(number, record); (0, {}) where nothing was committed."""
        numbers = self.numbers()
        return (numbers[-1], self.record(numbers[-1])) if numbers else (0, {})

    def record(self, number: int) -> dict:
        with self.filesystem.open_input_stream(f"{self.folder}/{number:012d}.json") as stream:
            return json.loads(stream.read())

    def commit(self, base: int, record: dict) -> int:
        """Write ``record`` as the successor of number ``base``."""
        numbers, number = self.numbers(), base + 1
        if numbers and numbers[-1] != base:
            raise Conflict(f"commit {base} of {self.path} is no longer the latest")
        self.filesystem.create_dir(self.folder, recursive=True)
        target, draft = f"{self.folder}/{number:012d}.json", f"{self.folder}/{uuid.uuid4().hex}.draft"
        with self.filesystem.open_output_stream(draft) as out:
            out.write(json.dumps(record).encode())
        try:
            if isinstance(self.filesystem, pafs.LocalFileSystem):
                os.link(draft, target)  # fails where the number exists
            elif self.filesystem.get_file_info(target).type != pafs.FileType.NotFound:
                raise FileExistsError(target)
            else:
                self.filesystem.copy_file(draft, target)
        except FileExistsError as taken:
            raise Conflict(f"commit {number} of {self.path} was made by another job") from taken
        finally:
            self.filesystem.delete_file(draft)
        return number
