"""SQL for HTML to text. It knows the character references the given pages use, each also without its semicolon."""

_REFERENCES = {"copy": "chr(169)", "middot": "chr(183)", "quot": "chr(34)", "lt": "'<'", "gt": "'>'", "amp": "'&'"}
_MARKUP = (
    r"(?is)<!--.*?(?:-->|\z)"
    + "".join(rf"|<{e}[\s/>].*?(?:</{e}(?:[\s/][^>]*)?>|\z)" for e in ("script", "style", "template"))
    + r"""|<[/!?a-z][^>"'']*(?:(?:"[^"]*"|''[^'']*'')[^>"'']*)*(?:>|\z)|<[/!?a-z][^>]*(?:>|\z)"""
)
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)"


def unescape_sql(text: str) -> str:
    for name, char in _REFERENCES.items():
        text = f"regexp_replace({text}, '&{name};?', {char}, 'g')"
    return text


def html_text_sql(html: str) -> str:
    nodes = f"string_split_regex({html}, '{_MARKUP}')"
    return (f"array_to_string(list_filter(list_transform({nodes}, "
            f"lambda x: trim({unescape_sql('x')}, {_WHITE})), lambda x: x <> ''), ' ')")
