"""The library's operators on the star-schema test tables, with reference SQL."""
