from tagloom.functions import convert, identity

__all__ = ["convert", "identity"]
