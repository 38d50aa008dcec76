"""Writers. They write with as many tasks as the data has, unless the table is known to be small."""
