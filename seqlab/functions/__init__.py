from seqlab.functions.draws import (  # noqa: F401
    draw_choice,
    draw_hash,
    draw_int,
    draw_uniform,
    scale_hash,
    stream_draw,
)
from seqlab.functions.text import (  # noqa: F401
    basename,
    count_chars,
    div,
    is_blank,
    percent_2dp,
    strip,
    zfill,
)
