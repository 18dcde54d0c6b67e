from seqlab.streaming.incremental import damage_stream, land_stream  # noqa: F401
