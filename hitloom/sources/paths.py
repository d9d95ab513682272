"""Where events, channel maps and parameter tables live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Paths:
    """Prefixes understood by Spark's file systems (``file:``, ``s3:``, ``hdfs:``)."""

    data: str
    maps: str
    params: str

    @classmethod
    def local(cls, root: str) -> Paths:
        base = "file://" + root.rstrip("/")
        return cls(f"{base}/scratch", f"{base}/map_files", f"{base}/prm")

    @classmethod
    def s3(cls, data_bucket: str, config_prefix: str) -> Paths:
        base = "s3://" + config_prefix.strip("/")
        return cls("s3://" + data_bucket.strip("/"), f"{base}/map_files", f"{base}/prm")

    @classmethod
    def hdfs(cls, authority: str, data: str, config: str) -> Paths:
        base = f"hdfs://{authority}/"
        config = base + config.strip("/")
        return cls(base + data.strip("/"), f"{config}/mapfiles", f"{config}/prm")

    def events(self, name: str) -> str:
        return f"{self.data}/{name}.parquet"

    def result(self, name: str, kind: str) -> str:
        """Output of one detector kind; each kind has a suffix of its own."""
        return f"{self.data}/{name}_{kind}.parquet"

    def map_file(self, name: str) -> str:
        return f"{self.maps}/{name}"

    def param_file(self, name: str) -> str:
        return f"{self.params}/{name}"
