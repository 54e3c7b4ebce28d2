"""The jobs composed from the operators: shop, clicks, finance, words, users."""
