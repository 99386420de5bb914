"""Training-data operators: tokenisation, de-duplication, filtering and formatting of text at corpus scale.

Nothing outside this folder imports it.
"""
