from encore.cli import main

main()
