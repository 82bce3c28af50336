"""The shared folder of the queries' own tables."""

from contractloom.sources.shared import fresh_path, shared_folder, written

__all__ = ["fresh_path", "shared_folder", "written"]
