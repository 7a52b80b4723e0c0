"""Opening files by URL in tasks, with retries and ranged reads. DataFrames are better read by Spark, which has its own."""

from __future__ import annotations

import io
import random
import time
from collections.abc import Callable
from typing import TypeVar
from urllib.parse import urlsplit

from pyarrow import fs

Result = TypeVar("Result")
#: Openers by scheme, besides local paths and what pyarrow's file systems know (file, s3, gs, hdfs, viewfs).
OPENERS: dict[str, Callable[[str], io.RawIOBase]] = {}


def retried(f: Callable[[], Result], attempts: int = 10, base: float = 0.1, most: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> Result:
    """f(), tried again after an OSError up to `attempts` times; the n-th pause is base * 2 ** n and up to a second more, `most` at most."""
    for n in range(attempts):
        try:
            return f()
        except OSError:
            if n + 1 == attempts:
                raise
            sleep(min(base * 2**n + random.random(), most))
    raise ValueError("no attempts")


class RetryingStream(io.RawIOBase):
    """A file read by ranges; a range that fails is asked for again, from a file that is opened again."""

    def __init__(self, opened: Callable[[], io.RawIOBase], attempts: int = 10, pause: float = 1.0):
        self.opened, self.attempts, self.pause = opened, attempts, pause
        self.file, self.at = retried(opened, attempts), 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        """Only the place of the next range; nothing is read or asked for. The end is found by the file itself."""
        if whence == io.SEEK_END:
            self.file.seek(offset, io.SEEK_END)
            self.at = self.file.tell()
        else:
            self.at = offset + (self.at if whence == io.SEEK_CUR else 0)
        return self.at

    def _again(self) -> None:
        self.file.close()
        self.file = self.opened()

    def readinto(self, buffer) -> int:
        def once() -> bytes:
            try:
                self.file.seek(self.at)
                return self.file.read(len(buffer))
            except OSError:
                self._again()
                raise

        data = retried(once, self.attempts, base=self.pause, most=self.pause)
        self.at += len(data)
        buffer[: len(data)] = data
        return len(data)


def open_url(url: str, attempts: int = 10) -> io.BufferedReader:
    """A file to read from: by its scheme's opener, or by pyarrow's file system; a path without a scheme is local."""
    scheme = urlsplit(url).scheme

    def opened() -> io.RawIOBase:
        if scheme in OPENERS:
            return OPENERS[scheme](url)
        if not scheme:
            return open(url, "rb")
        store, path = fs.FileSystem.from_uri(url)
        return store.open_input_file(path)

    return io.BufferedReader(RetryingStream(opened, attempts), 1 << 20)
