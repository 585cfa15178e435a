"""Operators of a training-data pipeline at corpus scale.

Each module holds one operator with its own general interface; ``queries``
holds the thin registered queries.  Nothing else in the library imports this
package.
"""
