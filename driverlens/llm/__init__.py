"""Operations on training text; the rest of the library does not import them."""
