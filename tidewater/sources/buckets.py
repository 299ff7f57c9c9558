"""A bucket directory that grows with the table's bytes (linear hashing).

A target table is stored in hash buckets of its key, one partition each, and a
load rewrites the buckets its rows fall into.  With a fixed number of buckets
that share never falls: at 100 TB a bucket of 16 holds 6 TB.  Here buckets are
split one after another, in turn, as the table grows, so that a bucket stays
near ``target_bytes`` and splitting one moves its rows to two: itself and one
new bucket, no other.  With n buckets, the largest power of two p <= n, a hash
h lies in bucket h mod 2p if that exists, else in h mod p.

The directory is one number, the bucket count, kept in the commit's meta with
the bytes of each bucket's folder next to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

TARGET_BYTES = 256 << 20


@dataclass(frozen=True)
class BucketDirectory:
    n: int = 1

    def __post_init__(self):
        if self.n < 1:
            raise ValueError("a directory has at least one bucket")

    @property
    def base(self) -> int:
        """The largest power of two that is at most the number of buckets."""
        return 1 << (self.n.bit_length() - 1)

    def bucket(self, *keys: str) -> Column:
        h = F.xxhash64(*[F.col(k) for k in keys])
        fine = F.pmod(h, F.lit(2 * self.base))
        return F.when(fine < self.n, fine).otherwise(F.pmod(h, F.lit(self.base))).cast("int")

    def grown_to(self, n: int) -> tuple["BucketDirectory", set[int]]:
        """The directory of ``n`` buckets, and the present buckets whose rows it deals anew."""
        if n <= self.n:
            return self, set()
        split = set()
        for new in range(self.n, n):
            home = new
            while home >= self.n:                 # the bucket of today that the new one's rows lie in
                home -= 1 << (home.bit_length() - 1)
            split.add(home)
        return BucketDirectory(n), split

    def for_bytes(self, held: int, coming: int, target_bytes: int, most_splits: int | None = None) -> tuple["BucketDirectory", set[int]]:
        """Grow so that ``held + coming`` bytes give about ``target_bytes`` a bucket.

        ``most_splits`` bounds the buckets split by one load (the next ones go
        on), so that no load rewrites a table that has outgrown its directory.
        """
        wanted = -(-(held + coming) // target_bytes)
        if held and most_splits is not None:
            wanted = min(wanted, self.n + most_splits)
        return self.grown_to(wanted)
