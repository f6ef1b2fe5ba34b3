from gustline.sinks.writer import Writer

__all__ = ["Writer"]
