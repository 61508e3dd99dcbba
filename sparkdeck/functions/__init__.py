"""Column expressions shared by the operators."""

from sparkdeck.functions.encode import flags_to_names, map_lookup, names_to_flags  # noqa: F401
from sparkdeck.functions.javatext import (  # noqa: F401
    is_blank,
    java_tokens,
    jsplit,
    jtrim,
    literal_sep,
    text_lines,
)
from sparkdeck.functions.numeric import (  # noqa: F401
    cube_root,
    cube_root_pow,
    ln,
    parse_number,
    reciprocal,
    sqrt,
)
