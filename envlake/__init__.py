"""Environmental-observation analytics expressed as Spark DataFrame plans."""

from envlake.session import configure, workspace

__all__ = ["configure", "workspace"]
