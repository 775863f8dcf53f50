"""ledgerlens: sales reports and table loading on Spark DataFrames."""

from ledgerlens.session import configure, get_session, scratch_path, scratch_root

__all__ = ["configure", "get_session", "scratch_path", "scratch_root"]
