from stationflow.sources.envelopes import next_offsets, once_per_position, read_envelopes

__all__ = ["next_offsets", "once_per_position", "read_envelopes"]
