from shopmart.cli import main

raise SystemExit(main())
