"""Archive sources, sinks and codecs."""
