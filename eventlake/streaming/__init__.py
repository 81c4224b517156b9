from eventlake.streaming.bronze import start_bronze
from eventlake.streaming.silver import start_silver

__all__ = ["start_bronze", "start_silver"]
