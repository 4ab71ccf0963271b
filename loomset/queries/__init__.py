"""Every operator as a query over the given tables, with SQL that checks it."""
